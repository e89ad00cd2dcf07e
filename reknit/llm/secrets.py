"""Secret scans: stated patterns, plus formats inferred from the credentials they find.

The credentials of each kind that the patterns find in the corpus are labelled strings of that
kind. From a bounded sample of them a prefix tree is built, whose statistically compatible
states are merged into a probabilistic automaton (ALERGIA: Hoeffding bounds, red and blue
states). Every other token that could be a credential, wherever it stands, is then scored by
its likelihood under each automaton against characters drawn evenly, and becomes a span of kind
``format`` where it scores nearly as well as held-out credentials do. Tokens are what lies
between base spans in a run of credential characters, and the pieces of it from any separator
to any other; how short they may be, and whether they need digits and letters, is what the
credentials show.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.session import materialize

KINDS = ("assign", "access", "hex", "format")

# The base patterns and their least lengths.
ASSIGN = re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

# What could be a credential of another place. A run as a whole with a digit and a letter in it
# is scored from this length on, whatever the credentials show.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
DIGIT_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z+/_=-]*+[0-9][A-Za-z0-9+/_=-]*+")
SEPARATOR = re.compile(r"[+/_=-]")
LONG = 16
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

# The sample that automata are inferred from: credentials per kind, and the longest one taken.
SAMPLE = 1_000
LONGEST = 256
# With fewer credentials of a kind no automaton is inferred.
LEAST_SAMPLE = 20
ALPHA = 0.05
# The threshold is this part of a score that all but so many held-out credentials reach, as
# credentials of the same characters may have other lengths; never less than LEAST_ODDS.
MISSED, PART, LEAST_ODDS = 0.05, 0.8, 0.5

EVEN = math.log2(66)
CLASS_SIZES = {"d": 10, "a": 6, "g": 20, "A": 6, "G": 20}


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, credential) of the stated patterns, by start, then kind.

    An assignment needs ``:`` or ``=``, and a hex run lies in a run of candidate characters,
    so that most texts are passed over quickly.
    """
    found = []
    if ":" in text or "=" in text:
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= ASSIGN_LEAST:
                found.append((match.start(), match.end(), 0, match[2]))
    if "AKIA" in text:
        found.extend((m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text))
    for run in CANDIDATE.finditer(text):
        if run.end() - run.start() >= 24:
            found.extend((m.start(), m.end(), 2, m[0])
                         for m in HEX.finditer(text, run.start(), run.end()))
    return sorted(found)


def symbols(value: str) -> str:
    """A string of character classes: digits, a-f, g-z, A-F, G-Z; other characters as they are."""
    return "".join("d" if c in "0123456789" else "a" if "a" <= c <= "f" else "g" if "g" <= c <= "z"
                   else "A" if "A" <= c <= "F" else "G" if "G" <= c <= "Z" else c for c in value)


@dataclass
class Automaton:
    """Per state: strings that came by, strings that ended, and (next state, strings) by symbol."""

    counts: list[int]
    ends: list[int]
    steps: list[dict[str, tuple[int, int]]]
    threshold: float = 0.0
    least: int = LONG
    digit: bool = True
    letter: bool = True

    def reach(self, text: str, start: int, stops: list[int]) -> int | None:
        """The last stop up to which a string of symbols from ``start`` scores well enough.

        Only strings count whose symbols all have steps: an unknown one ends the search.
        """
        state, total, place, best = 0, 0.0, start, None
        for stop in stops:
            while place < stop:
                step = self.steps[state].get(text[place])
                if step is None:
                    return best
                total += EVEN - math.log2(CLASS_SIZES.get(text[place], 1)) + math.log2(
                    (step[1] + 0.5) / (self.counts[state] + 6))
                state = step[0]
                place += 1
            n = stop - start
            if n < self.least or (self.digit and text.find("d", start, stop) < 0) or (
                    self.letter and not any(text.find(c, start, stop) >= 0 for c in "agAG")):
                continue
            ended = math.log2((self.ends[state] + 0.5) / (self.counts[state] + 6))
            if total + ended + math.log2(n + 1) >= self.threshold * n:
                best = stop
        return best

    def score(self, value: str) -> float:
        """Log odds per character against characters drawn evenly."""
        state, total, text = 0, 0.0, symbols(value)
        for symbol in text:
            total += EVEN - math.log2(CLASS_SIZES.get(symbol, 1))
            step = self.steps[state].get(symbol) if state is not None else None
            if step is None:
                # Unknown from here on: half a string's weight, and no state to go on from.
                seen = self.counts[state] if state is not None else 0
                total += math.log2(0.5 / (seen + 6))
                state = None
            else:
                total += math.log2((step[1] + 0.5) / (self.counts[state] + 6))
                state = step[0]
        seen, ended = (self.counts[state], self.ends[state]) if state is not None else (0, 0)
        total += math.log2((ended + 0.5) / (seen + 6)) + math.log2(len(text) + 1)
        return total / len(text)


def prefix_tree(values: list[str]) -> Automaton:
    tree = Automaton([0], [0], [{}])
    for value in values:
        state = 0
        tree.counts[0] += 1
        for symbol in symbols(value):
            after, seen = tree.steps[state].get(symbol, (len(tree.counts), 0))
            if not seen:
                tree.counts.append(0)
                tree.ends.append(0)
                tree.steps.append({})
            tree.steps[state][symbol] = after, seen + 1
            tree.counts[after] += 1
            state = after
        tree.ends[state] += 1
    return tree


def _differ(some: int, of: int, others: int, of_others: int, alpha: float) -> bool:
    bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(of) + 1 / math.sqrt(of_others))
    return abs(some / of - others / of_others) > bound


def _compatible(tree: Automaton, red: int, blue: int, alpha: float) -> bool:
    waiting = [(red, blue)]
    while waiting:
        one, other = waiting.pop()
        n, m = tree.counts[one], tree.counts[other]
        if _differ(tree.ends[one], n, tree.ends[other], m, alpha):
            return False
        here, there = tree.steps[one], tree.steps[other]
        for symbol in here.keys() | there.keys():
            a, b = here.get(symbol, (None, 0)), there.get(symbol, (None, 0))
            if _differ(a[1], n, b[1], m, alpha):
                return False
            if a[1] and b[1]:
                waiting.append((a[0], b[0]))
    return True


def _fold(tree: Automaton, red: int, blue: int) -> None:
    """Add the subtree of ``blue`` to ``red``."""
    waiting = [(red, blue)]
    while waiting:
        one, other = waiting.pop()
        tree.counts[one] += tree.counts[other]
        tree.ends[one] += tree.ends[other]
        for symbol, (after, seen) in tree.steps[other].items():
            if symbol in tree.steps[one]:
                target, before = tree.steps[one][symbol]
                tree.steps[one][symbol] = target, before + seen
                waiting.append((target, after))
            else:
                tree.steps[one][symbol] = after, seen


def infer(values: list[str], alpha: float = ALPHA) -> Automaton:
    """The automaton of some strings: compatible prefix-tree states merged, breadth first."""
    tree = prefix_tree(values)
    red, blue = [0], deque((0, symbol) for symbol in sorted(tree.steps[0]))
    while blue:
        parent, symbol = blue.popleft()
        state, seen = tree.steps[parent][symbol]
        if state in red:
            continue
        same = next((r for r in red if _compatible(tree, r, state, alpha)), None)
        if same is None:
            red.append(state)
            blue.extend((state, s) for s in sorted(tree.steps[state]))
            continue
        tree.steps[parent][symbol] = same, seen
        before = set(tree.steps[same])
        _fold(tree, same, state)
        blue.extend((same, s) for s in sorted(set(tree.steps[same]) - before))
        # Folding may have hung new tree states below other red ones.
        blue.extend((r, s) for r in red for s in sorted(tree.steps[r])
                    if tree.steps[r][s][0] not in red and (r, s) not in blue)
    place = {state: k for k, state in enumerate(red)}
    return Automaton([tree.counts[r] for r in red], [tree.ends[r] for r in red],
                     [{s: (place[t], n) for s, (t, n) in tree.steps[r].items()} for r in red])


def credentials(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct credentials that the base patterns find: kind, value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(KINDS[kind], value) for cell in batch.column(0)
                     for _, _, kind, value in base_spans(cell.as_py() or "")
                     if len(value) <= LONGEST}
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[k] for pair in found], pa.string()) for k in (0, 1)],
                names=["kind", "value"])

    return docs.select(F.col(text).cast("string")).mapInArrow(
        run, "kind string, value string").distinct()


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> list[Automaton]:
    """An automaton per kind that has enough credentials, each with its threshold.

    ``sample`` bounds the credentials per kind that are taken, those of the smallest hashes. A
    fifth of them is held out to set the threshold. No credentials give no automaton.
    """
    labelled = materialize(credentials(docs, text), "credentials")
    automata = []
    for kind in KINDS[:3]:
        rows = (labelled.filter(F.col("kind") == kind)
                .orderBy(F.xxhash64("value"), "value").limit(sample).collect())
        values = [row["value"] for row in rows]
        if len(values) < LEAST_SAMPLE:
            continue
        automaton = infer([v for k, v in enumerate(values) if k % 5])
        scores = sorted(automaton.score(v) for v in values[::5])
        automaton.threshold = max(LEAST_ODDS, PART * scores[int(MISSED * len(scores))])
        automaton.least = min(LONG, min(map(len, values)))
        most = (1 - MISSED) * len(values)
        automaton.digit = sum(bool(DIGIT.search(v)) for v in values) >= most
        automaton.letter = sum(bool(LETTER.search(v)) for v in values) >= most
        automata.append(automaton)
    return automata


def _formats(text: str, start: int, end: int,
             automata: list[Automaton]) -> list[tuple[int, int, int, str]]:
    """The spans in a stretch of credential characters: all of it, or pieces between separators.

    A piece is the longest from its start that scores well enough; those of several pieces
    between separators are as long as labelled credentials at most.
    """
    least = min(a.least for a in automata)
    if end - start < least:
        return []
    value = text[start:end]
    if len(value) >= LONG and DIGIT.search(value) and LETTER.search(value) and any(
            automaton.score(value) >= automaton.threshold for automaton in automata):
        return [(start, end, 3, value)]
    found, done, word = [], 0, symbols(value)
    stops = [match.start() for match in SEPARATOR.finditer(value)] + [len(value)]
    for k, stop in enumerate(stops):
        begin = stops[k - 1] + 1 if k else 0
        if begin < done or begin == stop:
            continue
        ends, after = [stop], k + 1
        while after < len(stops) and stops[after] - begin <= LONGEST:
            ends.append(stops[after])
            after += 1
        if ends[-1] - begin < least:
            continue
        best = max((a.reach(word, begin, ends) or 0 for a in automata), default=0)
        if best:
            found.append((start + begin, start + best, 3, value[begin:best]))
            done = best
    return found


def all_spans(text: str, automata: list[Automaton]) -> list[tuple[int, int, int, str]]:
    """Base spans and those that the automata add, by start, then kind; added ones meet no other."""
    found = base_spans(text)
    if not automata:
        return found
    added, done, base = [], 0, 0
    for run in (DIGIT_RUN if all(a.digit for a in automata) else RUN).finditer(text):
        # What base spans leave of the run; they come by their start.
        place = max(run.start(), done)
        while base < len(found) and found[base][0] < run.end():
            start, end, _, _ = found[base]
            added.extend(_formats(text, place, start, automata))
            place, base = max(place, end), base + 1
        added.extend(_formats(text, place, run.end(), automata))
        done = max(done, place)
    return sorted(found + added)


def listed(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind, _ in spans)


def find(docs: DataFrame, automata: list[Automaton], id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Per row: ``id``, the counts n_assign, n_access, n_hex, n_format, base_sha256 and spans.

    Positions are code points, ends exclusive. NULL and empty texts have no spans (an empty
    string, and its digest). Repeated rows each give a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans = [], []
            for cell in batch.column(1):
                found = all_spans(cell.as_py() or "", automata)
                kinds = [span[2] for span in found]
                for kind, column in enumerate(counts):
                    column.append(kinds.count(kind))
                base = listed([span for span in found if span[2] < 3])
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(listed(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["__id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    kind = docs.select(id).dtypes[0][1]
    return docs.select(F.col(id).alias("__id"), F.col(text).cast("string")).mapInArrow(
        run, f"__id {kind}, n_assign long, n_access long, n_hex long, n_format long, "
             "base_sha256 string, spans string").withColumnRenamed("__id", id)


def redacted(text: str, automata: list[Automaton], mark: str) -> str:
    """A text with every span replaced; overlapping spans become one mark."""
    pieces, done = [], 0
    for start, end, _, _ in all_spans(text, automata):
        if start >= done:
            pieces.extend((text[done:start], mark))
        done = max(done, end)
    return "".join(pieces) + text[done:] if pieces else text


def redact(docs: DataFrame, automata: list[Automaton], text: str = "text",
           mark: str = "[secret]") -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced by a mark; all other columns stay."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if cell is None else redacted(cell, automata, mark)
                     for cell in batch.column(place).to_pylist()]
            yield batch.set_column(place, text, pa.array(texts, batch.column(place).type))

    return docs.mapInArrow(run, docs.schema)
