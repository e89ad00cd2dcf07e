"""Secret scans against plain regular expressions, and the inferred automata."""

import hashlib
import random
import re

from reknit.llm import secrets


def plain_spans(text):
    """The stated patterns, one by one, without short cuts."""
    patterns = [
        (r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
         r"([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    return sorted((m.start(), m.end(), kind) for kind, (pattern, fits) in enumerate(patterns)
                  for m in re.finditer(pattern, text) if fits(m))


def hex_of(draw, n=40):
    return "".join(draw.choice("0123456789abcdef") for _ in range(n))


def texts():
    draw = random.Random(5)
    pieces = ["token = \"", "PASSWORD:", "secret=token:abcdef", "api_key", "apikey='", "AKIA", "é ",
              "\n", "== ", " ", "ſecret=abcdefgh", "passwd", ":", "=", "abcdefABCDEF", "x", "."]
    for _ in range(300):
        parts = [draw.choice([draw.choice(pieces), hex_of(draw, draw.randrange(1, 40)),
                              "".join(draw.choice("AKI0Z9") for _ in range(draw.randrange(30)))])
                 for _ in range(draw.randrange(12))]
        yield "".join(parts)
    yield "AKIA" + "A" * 15
    yield "AKIA" + "AKIA" * 9


def test_base_spans_as_plain_patterns():
    for text in texts():
        assert [span[:3] for span in secrets.base_spans(text)] == plain_spans(text), text


def test_automata_know_their_format():
    draw = random.Random(1)
    keys = ["AKIA" + "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
                             for _ in range(16)) for _ in range(400)]
    automaton = secrets.infer(keys[:300])
    assert len(automaton.counts) < 60 < len(secrets.prefix_tree(keys[:300]).counts)
    # All strings pass through the merged states with their probability mass kept.
    assert automaton.counts[0] >= 300
    low = min(automaton.score(key) for key in keys[300:])
    assert low > automaton.score("aaaa-bbbb-cccc-dddd") and low > automaton.score("x" * 20)
    for steps, count, ended in zip(automaton.steps, automaton.counts, automaton.ends):
        assert sum(n for _, n in steps.values()) + ended == count


def documents(spark):
    draw = random.Random(2)
    rows = [(k, f"prose token = \"{hex_of(draw)}\" more", "x") for k in range(80)]
    rows += [(100, None, "x"), (101, "", "x"), (102, "nothing here at all", "x"),
             (103, f"id {hex_of(draw, 22)} {hex_of(draw, 20)[:-1]}z1 end", "x"),
             (None, "password: hunter22", "x"), (104, "word " * 40_000 + "AKIA" + "Q" * 16, "x"),
             (104, "AKIA" + "Q" * 16, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string").selectExpr(
        "*", "1 AS n_hex", "2 AS __id")


def test_find_and_redact(spark):
    docs = documents(spark)
    automata = secrets.fit(docs)
    assert automata
    found = {}
    for row in secrets.find(docs, automata).collect():
        found.setdefault(row.doc_id, []).append(row)
    texts = {}
    for row in docs.collect():
        texts.setdefault(row.doc_id, []).append(row.text or "")
    for id, rows in found.items():
        for row, text in zip(sorted(rows, key=lambda r: len(r.spans)), sorted(texts[id], key=len)):
            base = plain_spans(text)
            counts = [sum(kind == k for *_, kind in base) for k in range(3)]
            assert [row.n_assign, row.n_access, row.n_hex] == counts
            listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, b, k in base)
            assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
            assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))
    # A hex string of a length that no base pattern takes is found by its format.
    assert found[103][0].n_format >= 1 and found[103][0].n_hex == 0
    assert found[102][0].spans == "" and found[100][0].spans == ""
    clean = secrets.redact(docs, automata)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    for row in clean.collect():
        assert row.text is None or not plain_spans(row.text)
    assert {r.doc_id: r.text for r in clean.collect()}[102] == "nothing here at all"


def test_without_credentials_or_rows(spark):
    docs = documents(spark).limit(0)
    assert secrets.fit(docs) == []
    assert secrets.find(docs, []).count() == 0
    assert secrets.redact(docs, []).columns == docs.columns


def test_formats_inside_runs_and_beside_spans():
    draw = random.Random(7)
    keys = [hex_of(draw, draw.choice((12, 22))) for _ in range(400)]
    automaton = secrets.infer(keys)
    automaton.threshold = 0.8 * min(automaton.score(key) for key in keys)
    automaton.least = 12
    key, short, base = hex_of(draw, 22), "3f9a0c77b1e2", hex_of(draw, 30)

    def found(text):
        spans = secrets.all_spans(text, [automaton])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]) if a[2] == 3 or b[2] == 3)
        return [(secrets.KINDS[kind], value) for _, _, kind, value in spans]

    for text in (f"AWS_SECRET_KEY={key} x", f"/path/{key}", f"see {key}_z/q", f"v:{key}", short):
        assert found(text) == [("format", key if key in text else short)], text
    assert found(f"zz{base}-{key}") == [("hex", base), ("format", key)]
    assert found(f"{key}/-{base}/zzzz")[0][1].startswith(key)
    assert found("a well-known state_of_the_art path/to/2024-11-30 ------ ====") == []


def test_needs_follow_the_credentials(spark):
    draw = random.Random(8)
    words = ["".join(draw.choice("ABCDEF") for _ in range(10)) for _ in range(200)]
    docs = spark.createDataFrame(
        [(k, f"password = {word}") for k, word in enumerate(words)], "doc_id long, text string")
    (automaton,) = secrets.fit(docs)
    assert (automaton.least, automaton.digit, automaton.letter) == (10, False, True)
    assert [s[3] for s in secrets.all_spans("it is FADEBCADEF here", [automaton])] == ["FADEBCADEF"]
