"""Streaming Viterbi against a search over whole texts, and exact round trips."""

import random

import pytest

from reknit.llm import pieces
from reknit.llm.queries import PIECES

VOCABULARY = pieces.load_vocabulary(PIECES)


def plain(text, vocabulary):
    """Ids of the best segmentation by a table over the whole text, no windows or caches."""
    best, back = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            known = vocabulary.ids.get(text[start:end])
            if known and best[start] + known[0] > best[end]:
                best[end], back[end] = best[start] + known[0], (start, known[1])
        if text[end - 1] not in vocabulary.ids:
            score = best[end - 1] + vocabulary.worst - pieces.UNKNOWN_PENALTY
            if score > best[end]:
                best[end], back[end] = score, (end - 1, None)
    ids, end = [], len(text)
    while end:
        start, id = back[end]
        ids[:0] = [id] if id is not None else [
            vocabulary.bytes[b] for b in text[start:end].encode()]
        end = start
    return ids


def small():
    return pieces.Vocabulary(
        ["<unk>", "a", "b", "ab", "aab", "ba", "▁", "▁a", "abab"],
        {"a": (-3.0, 1), "b": (-3.0, 2), "ab": (-4.0, 3), "aab": (-5.0, 4), "ba": (-4.5, 5),
         "▁": (-2.0, 6), "▁a": (-4.0, 7), "abab": (-7.5, 8)}, [], 0)


@pytest.mark.parametrize("stride", [1, 3, 64])
def test_streaming_as_whole_text(stride):
    draw = random.Random(stride)
    for vocabulary, letters in ((small(), "ab▁"), (VOCABULARY, "theanring▁▁é.日T")):
        for length in (1, 2, 15, 200, 700):
            text = "".join(draw.choice(letters) for _ in range(length))
            parts = list(pieces.viterbi(text, vocabulary, stride))
            found = [id for part in parts for id in part]
            assert found == plain(text, vocabulary), text
            if length == 700 and stride == 1:
                assert len(parts) > 5


def test_remembered_stretches_change_nothing():
    known = pieces._Remembered(VOCABULARY)
    draw = random.Random(2)
    for _ in range(200):
        text = "".join(draw.choice(["the", " ", "  ", "\n", "ing", "é", "x9", "日本", "▁", "\t", "."])
                       for _ in range(draw.randrange(40)))
        whole = ("▁" + text.replace(" ", "▁")) if text else ""
        assert pieces.encode_text(text, known) == [
            id for part in pieces.viterbi(whole, VOCABULARY) for id in part]
        assert pieces.decode_ids(pieces.encode_text(text, known), VOCABULARY.texts) == \
            text.replace("▁", " ")


def test_encode_and_decode_tables(spark):
    rows = [(1, "The cat\nsat  on the mat."), (2, None), (3, ""), (4, " "), (None, "naïve 日本 🙂"),
            (5, "x" * 50_000), (5, "word " * 30_000), (1, "The cat\nsat  on the mat.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS ids", "2 AS decoded", "3 AS row", "4 AS __ids_")
    coded = pieces.encode(docs, VOCABULARY)
    assert coded.columns == ["doc_id", "text", "decoded", "row", "__ids_", "ids"]
    for row in pieces.decode(coded, VOCABULARY).collect():
        assert row.decoded == row.text
        assert (row.ids is None) == (row.text is None)
        assert row.ids != [] or row.text == ""
    assert pieces.decode(pieces.encode(docs.limit(0), VOCABULARY), VOCABULARY).count() == 0


def test_lanes_as_single_streams():
    lanes = pieces.Lanes(VOCABULARY)
    draw = random.Random(8)
    stretches = {"".join(draw.choice("theanring,.é日🙂x9▁\t") for _ in range(draw.randrange(1, 49)))
                 for _ in range(3000)}
    found = dict(lanes.search(list(stretches)))
    assert set(found) == stretches
    for stretch, ids in found.items():
        assert list(ids) == [id for part in pieces.viterbi(stretch, VOCABULARY) for id in part]
    assert list(lanes.search([])) == []


def test_commits_on_the_texts_of_the_query(spark):
    """The stream of a whole text commits again and again, and gives the query's ids."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20)
    coded = pieces.encode(rows, VOCABULARY).collect()
    for row in coded:
        parts = list(pieces.viterbi(pieces.SPACE + row.text.replace(" ", pieces.SPACE), VOCABULARY))
        assert len(parts) >= len(row.text.split()) / 2
        assert [id for part in parts for id in part] == row.ids


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    known = pieces._Remembered(VOCABULARY)
    for text in ("the cat sat on the mat", "a dog, the cat", "x " * 40, "the mat " + "y" * 100):
        assert known.streams([text, "", text]) == [
            pieces.encode_text(text, pieces._Remembered(VOCABULARY)), [],
            pieces.encode_text(text, pieces._Remembered(VOCABULARY))]
