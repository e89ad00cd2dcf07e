"""Repaired conversations against a recursion over all edits, whole and in blocks."""

import hashlib
import random
from functools import cache

import pytest

from reknit.llm import conversations
from reknit.llm.conversations import EDITS, least_paths, repair, repaired, summary

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"s": "system", "u": "user", "a": "assistant"}


def slow(rows):
    """The result's columns for one conversation, by trying every edit at every place."""
    rows = [(turn, " " if role is None else role, " " if text is None else text)
            for turn, role, text in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.strip(" \t\n\v\f\r")
        if not shown:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append(None if shown[-1] in ".!?" else "truncated")
        if shown:
            seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]

    @cache
    def best(i, state, inserts):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 2:
            cost, audit, said = best(i, NEXT[state], inserts + 1)
            ways.append((cost + 3, "I" + audit, ((NAMES[NEXT[state]], ""), *said)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, said = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit, said))
            if faults[i] in (None, "truncated"):
                more = 3 * (faults[i] == "truncated")
                to = initials[i]
                if to == NEXT[state] or to == "s" and state == "":
                    cost, audit, said = best(i + 1, to, 0)
                    ways.append((cost + more, "K" + audit, ((role, text), *said)))
                cost, audit, said = best(i + 1, NEXT[state], 0)
                ways.append((cost + 3 + more, "R" + audit, ((NAMES[NEXT[state]], text), *said)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, said = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    text = "\n".join(f"{role}:{text}" for role, text in said)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256(text.encode()).hexdigest()), list(said)


def made(draw, size):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    texts = ["Hello.", "Yes!", "Why?", "no end", "", " \t", "a.", "b.", "c.", "é.\n", None]
    return [(draw.choice([None, *range(size)]), draw.choice(roles), draw.choice(texts))
            for _ in range(size)]


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(11)
    talks = {k: made(draw, draw.randrange(1, 13)) for k in range(150)}
    talks[None] = made(draw, 9)
    # Alternating ones, as they mostly are.
    for k in range(200, 260):
        size = draw.randrange(1, 12)
        talks[k] = [(t, ("user", "assistant")[t % 2], f"Say {t}{draw.choice(['.', '!', ''])}")
                    for t in range(size) if draw.random() > 0.15]
    return {k: rows for k, rows in talks.items() if rows}


def frame(spark, talks):
    rows = [(k, *row) for k, talk in talks.items() for row in talk]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).withColumnRenamed("text", "said") \
        .selectExpr("conv_id", "turn", "role", "said AS text", "1 AS block", "'x' AS audit",
                    "2 AS place")


@pytest.mark.parametrize("block_rows, block_bytes", [
    (20_000, 1 << 23), (5, 1 << 23), (2, 1 << 23), (1, 1 << 23), (20_000, 12)])
def test_same_as_all_edits(spark, talks, block_rows, block_bytes):
    blocks = repair(frame(spark, talks), block_rows=block_rows, block_bytes=block_bytes)
    found = {r[0]: tuple(r)[1:] for r in summary(blocks).collect()}
    assert found == {k: slow(rows)[0] for k, rows in talks.items()}
    if block_rows < 20_000:
        assert max(r.blocks for r in blocks.select("blocks").collect()) > 2


def test_repaired_rows(spark, talks):
    for blocks in (repair(frame(spark, talks)), repair(frame(spark, talks), block_rows=3)):
        rows = {}
        for r in repaired(blocks).orderBy("block", "place").collect():
            rows.setdefault(r.conv_id, []).append((r.role, r.text))
        assert rows == {k: said for k, talk in talks.items() if (said := slow(talk)[1])}


def test_absent_rows_make_their_conversation_known(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", "Hi.", False), (2, 0, "user", "Hi.", True), (2, 1, "user", "x.", False),
         (3, 5, None, None, None)], SCHEMA + ", present boolean")
    found = {r[0]: tuple(r)[1:] for r in summary(repair(rows, present="present")).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[1] == nothing and found[3] == nothing
    assert found[2][5:7] == (3, "KI")


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert summary(repair(empty)).count() == 0
    assert repaired(repair(empty, block_rows=1)).count() == 0


def test_hot_conversation_of_equal_rows(spark):
    """A conversation of many equal rows and none apart is dealt in blocks, text ids stay."""
    rows = spark.range(300).selectExpr(
        "IF(id % 3 = 0, 'hot', 'c' || id) AS conv_id", "IF(id % 2 = 0, 7, NULL) AS turn",
        "IF(id % 2 = 0, 'user', 'assistant') AS role", "'Same.' AS text")
    blocks = repair(rows, block_rows=10)
    assert dict(blocks.dtypes)["conv_id"] == "string"
    assert blocks.filter("conv_id = 'hot'").count() == 10
    (hot,) = summary(blocks).filter("conv_id = 'hot'").collect()
    # By turn, NULLs first: the assistant's rows, then the user's.
    assert (hot.duplicate, hot.blank, hot.gaps) == (98, 0, 0)
    assert hot.audit == slow([(None, "assistant", "Same.")] * 50
                             + [(7, "user", "Same.")] * 50)[0][6]


def test_long_audits_double():
    """Rows far longer than one word of ranks: paths come from pointers of all powers."""
    turns = list(range(3000))
    block = conversations.Block(turns, ["user"] * 3000, [f"t{k}." for k in turns])
    table = block.costs(conversations.ACCEPTED)
    (path,) = conversations.paths([block], [table], [conversations.ACCEPTED], [0])
    audit = "".join(EDITS[edit] for _, edit, _ in path)
    assert len(audit) >= 3000 and set(audit) <= set("DIKR")
    # Two users in a row: one of them is given the other role, or an answer comes between.
    assert table[0][0] == 4500


def test_least_paths_of_a_small_graph():
    import numpy as np

    # 0 -D-> 1 -K-> 2 end, 0 -K-> 2 end: the least is D, then K.
    arcs = np.array([(0, 3, 2), (0, 1, 1), (1, 3, 2), (2, 0, 2)])
    (path,) = least_paths(arcs, 3, np.array([0]))
    assert path[:, 1].tolist() == [1, 3]
    (path,) = least_paths(arcs, 3, np.array([2]))
    assert len(path) == 0
