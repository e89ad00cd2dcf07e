"""SentencePiece encoding and decoding by a streaming Viterbi search.

The ids of a text are the segmentation of the largest summed piece score, ties to the longer
last piece; characters that no piece covers fall back to their bytes. The search keeps scores
and backpointers for a window only: a position can be reached from the longest piece's length
behind it at most, so ids are committed as soon as the backpointer paths of all positions that
can still be continued meet in one boundary. The simplest such case is a place that no piece
reaches over: there is one path, and it is committed at once.

A text is one stream of stretches, which end where the stream always commits: before a space that
follows another character, and around line ends if no piece holds one. The streams of some
hundred texts advance together: the window of a stretch that is new to all of them is a lane of
arrays, in which every step extends all lanes by one character. What has been committed for a
stretch is remembered by the worker for a while, which gives the same ids.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.llm.memory import give_back

SPACE = "▁"
# A single character without a piece costs so much more than the worst piece.
UNKNOWN_PENALTY = 10.0
# How often convergence is looked for, in characters.
STRIDE = 64
LOWEST = float("-inf")
# Stretches up to this length are remembered: so many, and as many that were seen before them.
REMEMBERED_LENGTH, REMEMBERED = 48, 60_000
# Texts whose streams advance together.
TOGETHER = 200


@dataclass
class Vocabulary:
    """Pieces in id order, with their scores, ids by piece, byte ids, and what bounds a search."""

    pieces: list[str]
    ids: dict[str, tuple[float, int]]
    bytes: list[int]
    unknown: int

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        # A tree of characters: each step gives the steps after it, a score, and an id or -1.
        self.tree: dict[str, tuple] = {}
        for piece, (score, id) in sorted(self.ids.items()):
            steps = self.tree
            for character in piece[:-1]:
                steps = steps.setdefault(character, ({}, 0.0, -1))[0]
            steps[piece[-1]] = ({}, score, id)
        self.worst = min((score for score, _ in self.ids.values()), default=0.0)
        texts = [piece.replace(SPACE, " ").encode() for piece in self.pieces]
        for value, id in enumerate(self.bytes):
            texts[id] = bytes([value])
        self.texts = texts
        inside = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids)
        line = any("\n" in piece for piece in self.ids)
        parts = [] if inside else [f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"] if not line else [
            f"{SPACE}*[^{SPACE}]+|{SPACE}+"]
        self.stretches = re.compile(parts[0] if parts else r"(?s).+")


def load_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file with an identity normalizer."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    pieces = [model.id_to_piece(id) for id in every]
    plain = [id for id in every if not (model.is_byte(id) or model.is_control(id)
                                        or model.is_unknown(id) or model.is_unused(id))]
    byte_ids = [id for id in every if model.is_byte(id)]
    byte_ids.sort(key=lambda id: int(pieces[id][3:-1], 16))
    control = [id for id in every if model.is_control(id) or model.is_unknown(id)]
    for id in control:
        pieces[id] = ""
    return Vocabulary(pieces, {pieces[id]: (model.get_score(id), id) for id in plain}, byte_ids,
                      model.unk_id())


def viterbi(text: str, vocabulary: Vocabulary, stride: int = STRIDE) -> Iterator[list[int]]:
    """Ids of a text, in parts that are yielded as soon as they are certain."""
    tree, longest, length = vocabulary.tree, vocabulary.longest, len(text)
    unknown = vocabulary.worst - UNKNOWN_PENALTY
    # The window: by end position from ``done`` on, the best score and the piece that ends there.
    done = furthest = 0
    best: list[float] = [0.0] + [LOWEST] * min(length, stride + 2 * longest)
    start_of, id_of = [0] * len(best), [0] * len(best)
    for start in range(length):
        if done < start == furthest:
            # No piece reaches over this place, so every path passes it.
            yield _path(text, start_of, id_of, done, start, vocabulary)
            shift = start - done
            best = [0.0, *best[shift + 1:]]
            del start_of[:shift], id_of[:shift]
            done = start
            room = min(length - start, stride + 2 * longest) + 1 - len(best)
            if room > 0:
                best.extend([LOWEST] * room)
                start_of.extend([0] * room)
                id_of.extend([0] * room)
        place = start - done
        here = best[place]
        step, end = tree.get(text[start]), place + 1
        reach = end
        if (step is None or step[2] < 0) and here + unknown > best[end]:
            best[end], start_of[end], id_of[end] = here + unknown, start, -1
        while step is not None:
            steps, score, id = step
            if id >= 0:
                reach = end
                if here + score > best[end]:
                    best[end], start_of[end], id_of[end] = here + score, start, id
            if not steps or end + done == length:
                break
            step = steps.get(text[end + done])
            end += 1
        if reach + done > furthest:
            furthest = reach + done
        if place < stride:
            continue
        # Do the paths of all ends that can still be continued pass one boundary?
        ends = {end + done for end in range(place + 1, len(best)) if best[end] > LOWEST}
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(start_of[latest - done])
        boundary = ends.pop()
        if boundary > done:
            yield _path(text, start_of, id_of, done, boundary, vocabulary)
            shift = boundary - done
            base = best[shift]
            best = [score - base for score in best[shift:]]
            del start_of[:shift], id_of[:shift]
            done = boundary
        room = start - done + stride + 2 * longest - len(best)
        if room > 0:
            best.extend([LOWEST] * room)
            start_of.extend([0] * room)
            id_of.extend([0] * room)
    if done < length:
        yield _path(text, start_of, id_of, done, length, vocabulary)


def _path(text: str, start_of: list[int], id_of: list[int], begin: int, end: int,
          vocabulary: Vocabulary) -> list[int]:
    """Ids from one boundary to another along the backpointers."""
    parts, base = [], begin
    while end > begin:
        start, id = start_of[end - base], id_of[end - base]
        if id >= 0:
            parts.append(id)
        elif vocabulary.bytes:
            parts.extend(vocabulary.bytes[b] for b in
                         reversed(text[start:end].encode("utf-8", "surrogatepass")))
        else:
            parts.append(vocabulary.unknown)
        end = start
    parts.reverse()
    return parts


class Lanes:
    """The search over many short stretches at once, a step extending all by one character."""

    # Characters with a column of their own in the table of steps; others are looked up.
    COLUMNS = 128
    # Stretches that are searched together.
    WIDTH = 8192

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        often = Counter(chain.from_iterable(vocabulary.ids)).most_common(self.COLUMNS - 1)
        self.column = np.zeros(0x110000, np.uint8)
        for k, (character, _) in enumerate(often):
            self.column[ord(character)] = k + 1
        steps: dict[tuple[int, str], int] = {}
        ends: dict[int, tuple[float, int]] = {}
        for piece, found in vocabulary.ids.items():
            node = 0
            for character in piece:
                node = steps.setdefault((node, character), len(steps) + 1)
            ends[node] = found
        self.table = np.zeros((len(steps) + 1, self.COLUMNS), np.int32)
        rare = []
        for (node, character), then in steps.items():
            if column := self.column[ord(character)]:
                self.table[node, column] = then
            else:
                rare.append((node << 21 | ord(character), then))
        self.rare, self.rare_then = np.array(sorted(rare), np.int64).reshape(-1, 2).T
        self.score, self.id = np.zeros(len(steps) + 1), np.full(len(steps) + 1, -1, np.int32)
        for node, (score, id) in ends.items():
            self.score[node], self.id[node] = score, id

    def _step(self, node: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The nodes after some characters, 0 where no piece goes on."""
        column = self.column[codes]
        then = self.table[node, column]
        if len(self.rare) and not column.all():
            open_ = np.flatnonzero(column == 0)
            keys = node[open_].astype(np.int64) << 21 | codes[open_]
            place = np.minimum(np.searchsorted(self.rare, keys), len(self.rare) - 1)
            then[open_] = np.where(self.rare[place] == keys, self.rare_then[place], 0)
        return then

    def search(self, stretches: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Each stretch with its ids."""
        stretches = sorted(stretches, key=len)
        for start in range(0, len(stretches), self.WIDTH):
            yield from self._searched(stretches[start:start + self.WIDTH])

    def _searched(self, stretches: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        lengths = np.array(list(map(len, stretches)), np.int64)
        count, width = len(stretches), int(lengths[-1])
        codes = np.frombuffer("".join(s.ljust(width, "\0") for s in stretches).encode(
            "utf-32-le", "surrogatepass"), np.uint32).reshape(count, width).astype(np.int64)
        best = np.full((count, width + 1), LOWEST)
        best[:, 0] = 0
        start_of, id_of = np.zeros((count, width + 1), np.int32), np.full((count, width + 1), -1, np.int32)
        unknown = self.vocabulary.worst - UNKNOWN_PENALTY
        for start in range(width):
            lanes = np.arange(np.searchsorted(lengths, start, "right"), count)
            here, node = best[lanes, start], np.zeros(len(lanes), np.int32)
            for end in range(start + 1, min(width, start + self.vocabulary.longest) + 1):
                node = self._step(node, codes[lanes, end - 1])
                ids = self.id[node]
                found = here + self.score[node]
                if end == start + 1:
                    found = np.where(ids < 0, here + unknown, found)
                    better = found > best[lanes, end]
                else:
                    better = (ids >= 0) & (found > best[lanes, end])
                own = lanes[better]
                best[own, end], start_of[own, end], id_of[own, end] = found[better], start, ids[better]
                on = (node > 0) & (lengths[lanes] > end)
                if not on.any():
                    break
                lanes, here, node = lanes[on], here[on], node[on]
        # Along the backpointers, all lanes at once.
        out, free = np.zeros((count, width), np.int32), np.full(count, width)
        whole = np.ones(count, bool)
        lanes, ends = np.arange(count), lengths.copy()
        while len(lanes):
            ids = id_of[lanes, ends]
            whole[lanes[ids < 0]] = False
            free[lanes] -= 1
            out[lanes, free[lanes]] = ids
            ends = start_of[lanes, ends]
            lanes, ends = lanes[ends > 0], ends[ends > 0]
        for k, stretch in enumerate(stretches):
            if whole[k]:
                yield stretch, tuple(out[k, free[k]:].tolist())
            else:
                # It holds characters that are written in bytes.
                yield stretch, tuple(chain.from_iterable(viterbi(stretch, self.vocabulary)))


class _Remembered(dict):
    """Ids of stretches that the streams have committed before.

    As a broadcast value it lives as long as its worker, and what one task has coded serves
    the next ones. When it is full it becomes the older half, from which what is still used
    comes back.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.older: dict[str, tuple[int, ...]] = {}
        self.lanes: Lanes | None = None

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        """A long stretch is streamed by itself and not remembered."""
        return tuple(chain.from_iterable(viterbi(stretch, self.vocabulary)))

    def streams(self, texts: list[str]) -> list[list[int]]:
        """The ids of some texts, each of which gets a space in front."""
        if self.lanes is None:
            self.lanes = Lanes(self.vocabulary)
        found = self.vocabulary.stretches.findall
        stretches = [found(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        fresh = set().union(*stretches).difference(self)
        if len(self) + len(fresh) > REMEMBERED:
            self.older = dict(self)
            self.clear()
            fresh = set().union(*stretches)
        known = {s: ids for s in fresh if (ids := self.older.get(s)) is not None}
        self.update(known)
        self.update(self.lanes.search([
            s for s in fresh if s not in known and len(s) <= REMEMBERED_LENGTH]))
        return [list(chain.from_iterable(map(self.__getitem__, own))) for own in stretches]


def encode_text(text: str, known: _Remembered) -> list[int]:
    """The ids of one text."""
    return known.streams([text])[0]


def decode_ids(ids: list[int], texts: list[bytes]) -> str:
    """The text of some ids, without the space that encoding put in front."""
    if not ids:
        return ""
    found = b"".join(itemgetter(*ids)(texts) if len(ids) > 1 else (texts[ids[0]],))
    return found.decode("utf-8", "replace").removeprefix(" ")


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids",
           keep: Sequence[str] | None = None, check: str | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them, if not given) and an array of ids ``out``.

    With ``check`` a boolean column of that name tells whether the ids decode to the text again.
    A NULL text gives NULL ids and an empty one an empty array, which both count as the same
    again. ``out`` and ``check`` replace columns of those names.
    """
    keep = [name for name in (docs.columns if keep is None else keep)
            if name not in (out, check)]
    rows = docs.select(F.struct(*(F.col(f"`{n}`") for n in keep)).alias("row"),
                       F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(_Remembered(vocabulary))

    def coded(batch: pa.RecordBatch, known: _Remembered) -> pa.RecordBatch:
        found, offsets, total, same = [], [], 0, []
        values = batch.column(1).to_pylist()
        for value, ids in zip(values, known.streams([value or "" for value in values])):
            offsets.append(None if value is None else total)
            found.append(np.array(ids, np.int32))
            total += len(ids)
            same.append(check is None or decode_ids(ids, known.vocabulary.texts) == (value or ""))
        offsets.append(total)
        values = np.concatenate(found) if found else np.empty(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                       pa.array(values)), pa.array(same, pa.bool_())],
            names=["row", "ids", "same"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), TOGETHER):
                yield coded(batch.slice(start, TOGETHER), shared.value)
        give_back()

    row = rows.schema["row"].dataType.simpleString()
    checked = [] if check is None else [F.col("same").alias(check)]
    return rows.mapInArrow(run, f"row {row}, ids array<int>, same boolean").select(
        *(F.col(f"row.`{name}`") for name in keep), F.col("ids").alias(out), *checked)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids",
           out: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids in ``out``. NULL gives NULL, no ids an empty text.

    A literal U+2581 comes back as the space that it stands for in every such vocabulary.
    """
    cells = rows.select(F.struct(*(F.col(f"`{n}`") for n in rows.columns)).alias("row"),
                        F.col(ids).alias("ids"))

    texts = vocabulary.texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if value is None else decode_ids(value.tolist(), texts)
                     for value in map(_numbers, batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())],
                                             names=["row", "decoded"])

    row = cells.schema["row"].dataType.simpleString()
    return cells.mapInArrow(run, f"row {row}, decoded string").select(
        *(F.col(f"row.`{name}`") for name in rows.columns if name != out),
        F.col("decoded").alias(out))


def _numbers(cell: pa.ListScalar) -> np.ndarray | None:
    return None if not cell.is_valid else cell.values.to_numpy(zero_copy_only=False)
