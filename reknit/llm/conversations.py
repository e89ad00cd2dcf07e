"""Conversations put in order again: cheapest edits, and of these the least audit.

Rows of a conversation stand by turn. A row is blank (no visible character), else a duplicate (its
role and text were seen earlier), else truncated (it does not end with ``.!?``). Edits make the
initials of the roles read ``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 3, Insert
(an empty user or assistant, anywhere) 3, Delete 4; blank rows and duplicates have to be deleted,
truncated rows that stay cost 3 more. The audit is the initials of the edits in order, and of the
cheapest ones the least by ASCII is taken.

1. A dynamic program from the end gives each node (row, state of the pattern) its cost. The arcs
   that keep to it are the optimal ones; no two that leave a node bear the same initial.
2. Optimal arcs are ranked by their first 1, 2, 4, ... initials: the rank by twice as many comes
   from an arc's own rank and that of the arc its doubled pointer names. Ranks select the first
   arc, doubled pointers lead to all arcs of its path at once.

Short conversations are solved side by side, each within one task. A conversation of more rows or
bytes than a block holds is cut into blocks, which are solved apart from each other: first the
costs between their ends (a matrix of the four states), which are put together per conversation,
then the end that each block's least path reaches from each state, and at last the paths. So no
task ever holds more than some blocks, and of a conversation as a whole only its matrices. The
hash of a long conversation's result runs over its blocks in order, in one pass of one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.operators.keys import number_rows
from reknit.session import broadcast_if_small, materialize, measure

# A block holds so many rows and bytes of a conversation, a longer one is cut into blocks.
BLOCK_ROWS, BLOCK_BYTES = 20_000, 8 * 1024 * 1024

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
NONE = 1 << 60

# States: nothing yet, after system, after user, after assistant; and what may come next.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = ("", "system", "user", "assistant")
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# Costs of ending a conversation in a state.
ACCEPTED = (0, NONE, NONE, 0)

SPACES = " \t\n\v\f\r"
LEGAL = {"su", "ua", "au"}

# Fixed order: the initials of the edits by ASCII; END stands below them.
END, EDITS = 0, ".DIKR"


class Block:
    """Rows of a conversation with their faults, ready to be solved."""

    def __init__(self, turns: list, roles: list[str], texts: list[str],
                 again: list[bool] | None = None, last: bool = True):
        self.roles, self.texts, self.last = roles, texts, last
        seen: set[tuple[str, str]] = set()
        self.gone: list[bool] = []
        self.cut: list[bool] = []
        self.blank = self.duplicate = 0
        for k, (role, text) in enumerate(zip(roles, texts)):
            shown = text.rstrip(SPACES)
            blank = not shown
            repeated = not blank and ((role, text) in seen if again is None else again[k])
            if again is None and not blank:
                seen.add((role, text))
            self.blank += blank
            self.duplicate += repeated
            self.gone.append(blank or repeated)
            self.cut.append(not blank and not repeated and shown[-1] not in ".!?")
        self.truncated = sum(self.cut)
        self.initials = [role[:1] for role in roles]
        self.illegal = sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:]))
        stated = [turn for turn in turns if turn is not None]
        self.turns = (min(stated), max(stated), len(set(stated))) if stated else None

    def kept_state(self, state: int, row: int) -> int | None:
        """The state after keeping a row, or None where it may not stay."""
        kind = INITIALS.get(self.initials[row])
        if kind == NEXT[state] or kind == SYSTEM and state == START:
            return kind
        return None

    def costs(self, ends: tuple[int, ...]) -> list[list[int]]:
        """Of each place and state the cheapest way to the end, given the cost of the end's states.

        Inserts at the end belong to the block that comes after, if there is one.
        """
        now = list(ends)
        if self.last:
            self._insert(now)
        table = [now]
        for row in range(len(self.roles) - 1, -1, -1):
            after, now = now, [cost + DELETE for cost in now]
            if not self.gone[row]:
                more = CUT * self.cut[row]
                for state in range(4):
                    kept = self.kept_state(state, row)
                    best = after[NEXT[state]] + REROLE if kept is None else min(
                        after[kept] + KEEP, after[NEXT[state]] + REROLE)
                    now[state] = min(now[state], best + more)
            self._insert(now)
            table.append(now)
        return table[::-1]

    @staticmethod
    def _insert(now: list[int]) -> None:
        user, assistant = now[USER], now[ASSISTANT]
        now[USER] = min(user, assistant + INSERT)
        now[ASSISTANT] = min(assistant, user + INSERT)
        now[START] = min(now[START], now[USER] + INSERT)
        now[SYSTEM] = min(now[SYSTEM], now[USER] + INSERT)

    def arcs(self, table: list[list[int]], ends: tuple[int, ...]) -> Iterator[tuple[int, int, int]]:
        """Optimal arcs (node, edit, node after), nodes being 4 * place + state, ends last."""
        size = len(self.roles)
        for place, now in enumerate(table):
            after = table[place + 1] if place < size else None
            for state, cost in enumerate(now):
                node, then = 4 * place + state, NEXT[state]
                if cost >= NONE:
                    continue
                if after is None and cost == ends[state]:
                    yield node, END, node
                    continue
                if after and cost == after[state] + DELETE:
                    yield node, 1, node + 4
                if (after or self.last) and cost == now[then] + INSERT:
                    yield node, 2, 4 * place + then
                if after and not self.gone[place]:
                    more = CUT * self.cut[place]
                    kept = self.kept_state(state, place)
                    if kept is not None and cost == after[kept] + KEEP + more:
                        yield node, 3, 4 * place + 4 + kept
                    if cost == after[then] + REROLE + more:
                        yield node, 4, 4 * place + 4 + then


def least_paths(arcs: np.ndarray, nodes: int, roots: np.ndarray) -> list[np.ndarray]:
    """The arcs of the least path from each root, by prefix doubling.

    ``arcs`` are rows of (node, edit, node after); an arc with edit END leads to its own node and
    ends a path. Of a node's arcs no two have the same edit.
    """
    node, edit, then = arcs.T
    # By node, then edit: the first arc of a node has its least rank.
    order = np.lexsort((edit, node))
    node, edit, then = node[order], edit[order], then[order]
    first = np.searchsorted(node, np.arange(nodes + 1))
    ranks = np.unique(edit, return_inverse=True)[1]
    pointers = [np.where(edit == END, np.arange(len(edit)), first[then])]
    lengths = (edit != END).astype(np.int64)
    while True:
        pointer = pointers[-1]
        both = ranks * (ranks.max() + 1) + ranks[pointer]
        ranks = np.unique(both, return_inverse=True)[1]
        lengths = lengths + np.where(pointer != np.arange(len(edit)), lengths[pointer], 0)
        if (edit[pointer] == END).all():
            break
        pointers.append(pointer[pointer])
    # Of a root's arcs the one of least rank.
    begins = np.array([first[r] + int(np.argmin(ranks[first[r]:first[r + 1]])) for r in roots],
                      np.int64)
    sizes = lengths[begins]
    steps = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.repeat(begins, sizes)
    for power, pointer in enumerate(pointers):
        place = np.where((steps >> power) & 1 == 1, pointer[place], place)
    found = np.stack([node[place], edit[place], then[place]], axis=1)
    return np.split(found, np.cumsum(sizes)[:-1]) if len(sizes) else []


def paths(blocks: list[Block], tables: list[list[list[int]]], ends: list[tuple[int, ...]],
          states: list[int]) -> list[np.ndarray]:
    """The least path of each block from the given state at its beginning."""
    arcs, roots, base = [], [], 0
    for block, table, end, state in zip(blocks, tables, ends, states):
        own = np.array(list(block.arcs(table, end)), np.int64).reshape(-1, 3)
        own[:, 0] += base
        own[:, 2] += base
        arcs.append(own)
        roots.append(base + state)
        base += 4 * len(table)
    found = least_paths(np.concatenate(arcs), base, np.array(roots, np.int64)) if blocks else []
    firsts = np.cumsum([0, *(4 * len(table) for table in tables)])
    return [path - [int(a), 0, int(a)] for path, a in zip(found, firsts)]


def edited(block: Block, path: np.ndarray) -> list[dict]:
    """Edits in order, with what they leave in the conversation (NULL for a deleted row)."""
    out = []
    for node, edit, then in path.tolist():
        row, name = node // 4, EDITS[edit]
        if name == "K":
            role, text = block.roles[row], block.texts[row]
        elif name == "R":
            role, text = NAMES[then % 4], block.texts[row]
        elif name == "I":
            role, text = NAMES[then % 4], ""
        else:
            role = text = None
        out.append({"edit": name, "role": role, "text": text})
    return out


TURNS = "array<struct<edit: string, role: string, text: string>>"
_TURNS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
TOTALS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _gaps(turns: tuple[int, int, int] | None) -> int:
    return turns[1] - turns[0] + 1 - turns[2] if turns else 0


def _blocks(batch: pa.RecordBatch) -> list[Block]:
    column = batch.column("rows")
    flat = column.flatten()
    names = [flat.type.field(k).name for k in range(flat.type.num_fields)]
    fields = {name: flat.field(name).to_pylist() for name in names}
    sizes = np.cumsum([0, *(len(cell) for cell in column)])
    lasts = batch.column("last").to_pylist() if "last" in batch.schema.names else None
    return [Block(fields["turn"][a:b], fields["role"][a:b], fields["text"][a:b],
                  fields["again"][a:b] if "again" in fields else None,
                  lasts[k] if lasts is not None else True)
            for k, (a, b) in enumerate(zip(sizes[:-1].tolist(), sizes[1:].tolist()))]


def repair(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", present: str | None = None, block_rows: int = BLOCK_ROWS,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per conversation and block: ``id``, block, blocks, gaps, blank, duplicate, truncated,
    illegal, cost (of the whole conversation), audit and turns (of the block).

    Rows stand by turn (NULLs first), then role and text; equal rows are told apart by nothing.
    ``turns`` are the edits in order with the role and text that they leave; :func:`summary` and
    :func:`repaired` read the result. A NULL role or text counts as one space; rows without a
    conversation are one of their own. ``gaps`` leaves NULL turns out. A conversation whose rows
    are all false in the column ``present`` has one block without rows, and cost 0. Other
    columns, whatever their names, play no part; an empty table gives an empty one.
    """
    kind = rows.schema[id].dataType.simpleString()
    here = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    rows = rows.select(
        F.col(id).alias("id"), F.col(turn).cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(to)
          for c, to in ((role, "role"), (text, "text"))), here.alias("here"))
    sizes = rows.filter("here").groupBy("id").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    long = sizes.filter((F.col("n") > block_rows) | (F.col("bytes") > block_bytes))
    long = materialize(long.withColumn("conv", F.monotonically_increasing_id()), "long")
    size = measure(long)
    short = rows if size == 0 else rows.join(
        broadcast_if_small(long.select(F.col("id").alias("long_id")), size),
        F.col("id").eqNullSafe(F.col("long_id")), "left_anti")
    blocks = _short(short, kind)
    if size == 0:
        return blocks.withColumnRenamed("id", id)
    cells = rows.filter("here").drop("here").join(
        broadcast_if_small(long.withColumnRenamed("id", "long_id"), size),
        F.col("id").eqNullSafe(F.col("long_id")))
    least = F.floor(F.lit(block_bytes) * F.col("n") / F.greatest("bytes", F.lit(1)))
    cells = cells.select("conv", "turn", "role", "text", F.greatest(
        F.lit(1), F.least(F.lit(block_rows), least)).cast("long").alias("width"))
    parts = _long(cells).join(broadcast_if_small(long.select("conv", "id"), size), "conv")
    return blocks.unionByName(parts.select(*blocks.columns)).withColumnRenamed("id", id)


def _solved(kind: str, extra: str = "") -> str:
    return (f"id {kind}, block long, blocks long, "
            f"{', '.join(f'{name} long' for name in TOTALS)}, audit string, turns {TURNS}{extra}")


def _short(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations that fit into one block."""
    cell = F.when(F.col("here"), F.struct("turn", "role", "text"))
    grouped = rows.groupBy("id").agg(F.sort_array(F.collect_list(cell)).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _blocks(batch)
            tables = [block.costs(ACCEPTED) for block in found]
            ways = paths(found, tables, [ACCEPTED] * len(found), [START] * len(found))
            turns = [edited(block, way) for block, way in zip(found, ways)]
            totals = {"gaps": [_gaps(b.turns) for b in found], "blank": [b.blank for b in found],
                      "duplicate": [b.duplicate for b in found],
                      "truncated": [b.truncated for b in found],
                      "illegal": [b.illegal for b in found],
                      "cost": [table[0][START] for table in tables]}
            count = len(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([0] * count, pa.int64()),
                 pa.array([1] * count, pa.int64()),
                 *(pa.array(totals[name], pa.int64()) for name in TOTALS),
                 pa.array(["".join(t["edit"] for t in cells) for cells in turns], pa.string()),
                 pa.array(turns, _TURNS)],
                names=["id", "block", "blocks", *TOTALS, "audit", "turns"])

    return grouped.mapInArrow(run, _solved(kind))


def _long(cells: DataFrame) -> DataFrame:
    """Conversations in blocks: the columns of :func:`_short`, with ``conv`` in place of the id."""
    placed = materialize(
        number_rows(cells, ["conv", "turn", "role", "text"], "place"), "placed")
    begins = placed.groupBy("conv").agg(F.min("place").alias("begin"), F.count("*").alias("n"))
    # A text may be that of a third of all rows: one row per text, and AQE splits the others.
    firsts = placed.groupBy("conv", "role", "text").agg(F.min("place").alias("first"))
    parts = (placed.join(firsts, ["conv", "role", "text"]).join(begins, "conv")
             .withColumn("block", F.expr("(place - begin) div width"))
             .withColumn("blocks", F.expr("(n - 1) div width + 1")))
    cell = F.struct("place", "turn", "role", "text", (F.col("place") > F.col("first")).alias("again"))
    blocks = materialize(
        parts.groupBy("conv", "block", "blocks").agg(
            F.sort_array(F.collect_list(cell)).alias("rows"))
        .withColumn("last", F.expr("block + 1 = blocks")), "blocks")

    # 1. Costs between the ends of each block, put together from the end.
    told = ("conv long, block long, blocks long, costs array<bigint>, turns array<bigint>, "
            "before string, after string, blank long, duplicate long, truncated long, illegal long")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _blocks(batch)
            costs = [[cost for end in range(4) for cost in block.costs(
                tuple(0 if s == end else NONE for s in range(4)) if not block.last
                else tuple(ACCEPTED[s] if s == end else NONE for s in range(4)))[0]]
                for block in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("conv", "block", "blocks")),
                 pa.array(costs, pa.list_(pa.int64())),
                 pa.array([b.turns for b in found], pa.list_(pa.int64())),
                 pa.array([b.initials[0] for b in found], pa.string()),
                 pa.array([b.initials[-1] for b in found], pa.string()),
                 *(pa.array([getattr(b, name) for b in found], pa.int64())
                   for name in TOTALS[1:5])],
                names=["conv", "block", "blocks", "costs", "turns", "before", "after",
                       *TOTALS[1:5]])

    def together(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        ends, now = [], ACCEPTED
        for costs, last in zip(group["costs"][::-1], [True] + [False] * (len(group) - 1)):
            ends.append(now)
            table = np.minimum(np.array(costs, np.int64).reshape(4, 4), NONE)
            # Costs to an end's state, and from there on; the last block holds its own ends.
            on = np.array([0] * 4 if last else now, np.int64)[:, None]
            now = tuple(int(x) for x in np.minimum(table + on, NONE).min(axis=0))
        turns = [t for t in group["turns"] if t is not None]
        distinct = sum(int(t[2]) for t in turns) - sum(
            int(a[1] == b[0]) for a, b in zip(turns, turns[1:]))
        seams = sum(a + b not in LEGAL for a, b in zip(group["after"], group["before"][1:]))
        totals = {"gaps": _gaps((int(turns[0][0]), int(turns[-1][1]), distinct) if turns else None),
                  **{name: int(group[name].sum()) for name in TOTALS[1:4]},
                  "illegal": int(group["illegal"].sum()) + seams, "cost": now[START]}
        return pd.DataFrame({"conv": group["conv"], "block": group["block"],
                             "ends": [list(e) for e in ends[::-1]], **totals})

    totals = ", ".join(f"{name} long" for name in TOTALS)
    costs = materialize(
        blocks.mapInArrow(measured, told).groupBy("conv").applyInPandas(
            together, f"conv long, block long, ends array<bigint>, {totals}"), "costs")
    ready = blocks.join(costs, ["conv", "block"])

    # 2. Where the least path from each state leaves each block, followed from the start.
    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _blocks(batch)
            ends = [tuple(e) for e in batch.column("ends").to_pylist()]
            tables = [block.costs(end) for block, end in zip(found, ends)]
            open_ = [(k, s) for k, table in enumerate(tables) for s in range(4)
                     if table[0][s] < NONE]
            ways = []
            for k, s in open_:
                ways += paths([found[k]], [tables[k]], [ends[k]], [s])
            to = [[-1] * 4 for _ in found]
            for (k, s), way in zip(open_, ways):
                to[k][s] = int(way[-1][2]) % 4 if len(way) else s
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("block"), pa.array(to, pa.list_(pa.int64()))],
                names=["conv", "block", "to"])

    def entered(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        states, state = [], START
        for to in group["to"]:
            states.append(state)
            state = int(to[state])
        return pd.DataFrame({"conv": group["conv"], "block": group["block"], "state": states})

    states = materialize(
        ready.mapInArrow(left, "conv long, block long, to array<bigint>").groupBy("conv")
        .applyInPandas(entered, "conv long, block long, state long"), "states")

    # 3. The paths.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _blocks(batch)
            ends = [tuple(e) for e in batch.column("ends").to_pylist()]
            tables = [block.costs(end) for block, end in zip(found, ends)]
            ways = paths(found, tables, ends, batch.column("state").to_pylist())
            turns = [edited(block, way) for block, way in zip(found, ways)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("conv", "block", "blocks", *TOTALS)),
                 pa.array(["".join(t["edit"] for t in cells) for cells in turns], pa.string()),
                 pa.array(turns, _TURNS)],
                names=["conv", "block", "blocks", *TOTALS, "audit", "turns"])

    return ready.join(states, ["conv", "block"]).mapInArrow(
        run, _solved("long").replace("id long", "conv long", 1))


def repaired(blocks: DataFrame, id: str = "conv_id") -> DataFrame:
    """The repaired conversations: ``id``, block, place (in the block), edit, role, text."""
    return (blocks.select(id, "block", F.posexplode("turns").alias("place", "cell"))
            .filter("cell.edit <> 'D'").select(id, "block", "place", "cell.*"))


def summary(blocks: DataFrame, id: str = "conv_id") -> DataFrame:
    """Per conversation: ``id``, the totals, audit, repaired_sha256 (of ``role:text`` lines).

    A conversation in blocks is hashed by one task that reads them in order and holds one.
    """
    kind = blocks.schema[id].dataType.simpleString()
    lines = F.transform(F.filter("turns", lambda t: t["edit"] != "D"),
                        lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    shown = blocks.withColumnRenamed(id, "id").withColumn("lines", F.array_join(lines, "\n")) \
        .withColumn("any", F.size(lines) > 0)
    whole = shown.filter("blocks = 1").select(
        "id", *TOTALS, "audit", F.sha2("lines", 256).alias("repaired_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, audit, begun = hashlib.sha256(), [], False
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] == 0:
                    digest, audit, begun = hashlib.sha256(), [], False
                if row["any"]:
                    digest.update((b"\n" if begun else b"") + row["lines"].encode("utf-8"))
                    begun = True
                audit.append(row["audit"])
                if row["block"] + 1 == row["blocks"]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["id"]], batch.schema.field("id").type),
                         *(pa.array([row[name]], pa.int64()) for name in TOTALS),
                         pa.array(["".join(audit)], pa.string()),
                         pa.array([digest.hexdigest()], pa.string())],
                        names=["id", *TOTALS, "audit", "repaired_sha256"])

    parts = (shown.filter("blocks > 1")
             .select("id", "block", "blocks", *TOTALS, "audit", "lines", "any")
             .repartition("id").sortWithinPartitions("id", "block"))
    hashed = parts.mapInArrow(run, f"id {kind}, {', '.join(f'{n} long' for n in TOTALS)}, "
                                   "audit string, repaired_sha256 string")
    return whole.unionByName(hashed).withColumnRenamed("id", id)
