"""Secret scans by grammar inference.

Labelled credentials (the values that the fixed base patterns find) are a bounded
sample for one automaton per kind: their prefix tree is folded by merging states
whose outgoing symbols and endings are statistically compatible (Hoeffding
bounds), which leaves a probabilistic automaton of the format.  Every other run of
the credentials' alphabet and least length is then scored by its likelihood per
character under each automaton, and under a model of ordinary runs: one that is as
likely as the credentials themselves, and more so than as an ordinary run, is reported.

Symbols of an automaton are classes of characters, so it has few arcs and its format
is learned from few examples.  Ordinary runs are those too short for a credential;
pairs of letters tell how they are made.

The samples are at most ``SAMPLE`` values per kind and ``ORDINARY`` other runs, the
smallest by hash of the value, so they do not depend on the order or placing of rows.
All rows are scanned, each where it lies, texts of any length whole.  A null text is read as empty; repeated rows are
scanned each for itself; other columns are ignored; without any credential in
the table there is no automaton and only base spans are reported.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from heapq import nsmallest
from math import log, sqrt
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.llm.common import or_empty, slices, smallest, stage

SAMPLE = 1000
ALPHA = 0.05
# A candidate passes at the likelihood that this share of the credentials reach.
REACHED = 0.98
KINDS = ["assign", "access", "hex"]
FOUND = "format"

# The base patterns.  Runs are maximal, so a lower bound in the
# pattern drops exactly the matches that are too short.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12

# Every run of the alphabet of labelled values, as long as those are, is scored.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % ASSIGN_LEAST)
# Shorter runs are ordinary ones; at most ORDINARY of them are learned from.
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{4,%d}(?![A-Za-z0-9+/_.=-])" % (ASSIGN_LEAST - 1))
ORDINARY = 5000
PLAIN = "ordinary"
# Verdicts on candidates that a worker keeps.
KNOWN_CANDIDATES = 200_000


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base patterns, by start and then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def symbols(value: str) -> str:
    """Character classes: digits, a-f, g-z, A-F, G-Z, and other signs as they are."""
    return "".join(
        "0" if "0" <= c <= "9" else "a" if "a" <= c <= "f" else "g" if "g" <= c <= "z" else "A" if "A" <= c <= "F" else "G" if "G" <= c <= "Z" else c
        for c in value
    )


# How many characters each class stands for.
CLASS_SIZE = {"0": 10, "a": 6, "g": 20, "A": 6, "G": 20}


class PrefixTree:
    """Counts of passes, endings and arcs; states are merged in place."""

    def __init__(self, values: Sequence[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.passes, self.ends = [0], [0]
        for value in values:
            node = 0
            self.passes[0] += 1
            for symbol in value:
                below = self.arcs[node]
                if symbol not in below:
                    below[symbol] = len(self.arcs)
                    self.arcs.append({})
                    self.passes.append(0)
                    self.ends.append(0)
                node = below[symbol]
                self.passes[node] += 1
            self.ends[node] += 1

    def _differ(self, hits_a: int, of_a: int, hits_b: int, of_b: int) -> bool:
        bound = sqrt(0.5 * log(2 / ALPHA)) * (1 / sqrt(of_a) + 1 / sqrt(of_b))
        return abs(hits_a / of_a - hits_b / of_b) > bound

    def compatible(self, a: int, b: int) -> bool:
        """Whether endings and arcs agree, here and along common arcs."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            if a == b:
                continue
            of_a, of_b = self.passes[a], self.passes[b]
            if self._differ(self.ends[a], of_a, self.ends[b], of_b):
                return False
            for symbol in self.arcs[a].keys() | self.arcs[b].keys():
                to_a, to_b = self.arcs[a].get(symbol), self.arcs[b].get(symbol)
                hits_a = self.taken[a].get(symbol, 0)
                hits_b = self.taken[b].get(symbol, 0)
                if self._differ(hits_a, of_a, hits_b, of_b):
                    return False
                if to_a is not None and to_b is not None and self.parents[to_b] == b:
                    waiting.append((to_a, to_b))
        return True

    def fold(self, a: int, b: int) -> None:
        """Adds the tree below b to the automaton at a."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            self.passes[a] += self.passes[b]
            self.ends[a] += self.ends[b]
            for symbol, child in self.arcs[b].items():
                self.taken[a][symbol] = self.taken[a].get(symbol, 0) + self.taken[b][symbol]
                if symbol in self.arcs[a]:
                    waiting.append((self.arcs[a][symbol], child))
                else:
                    self.arcs[a][symbol] = child
                    self.parents[child] = a

    def infer(self) -> None:
        """Takes states in order of depth: merged into a settled one, or settled."""
        self.taken = [{s: self.passes[n] for s, n in below.items()} for below in self.arcs]
        self.parents = [0] * len(self.arcs)
        for node, below in enumerate(self.arcs):
            for child in below.values():
                self.parents[child] = node
        settled = [0]
        seen = {0}
        waiting = [(0, symbol) for symbol in sorted(self.arcs[0])]
        while waiting:
            node, symbol = waiting.pop(0)
            child = self.arcs[node][symbol]
            if child in seen:
                continue
            for state in settled:
                if self.compatible(state, child):
                    self.arcs[node][symbol] = state
                    before = {s: set(self.arcs[s]) for s in settled}
                    self.fold(state, child)
                    for s in settled:
                        waiting += [(s, x) for x in sorted(set(self.arcs[s]) - before[s])]
                    break
            else:
                settled.append(child)
                seen.add(child)
                waiting += [(child, s) for s in sorted(self.arcs[child])]
        self.settled = settled


@dataclass(frozen=True)
class Automaton:
    """Arcs by state and symbol (next state, log probability), endings, and the passing score."""

    arcs: dict[tuple[int, str], tuple[int, float]]
    ends: dict[int, float]
    passing: float

    def score(self, value: str) -> float:
        """Mean log likelihood of a character; minus infinity if the format excludes the value."""
        state, total = 0, 0.0
        for symbol in symbols(value):
            arc = self.arcs.get((state, symbol))
            if arc is None:
                return float("-inf")
            state, total = arc[0], total + arc[1]
        end = self.ends.get(state)
        return float("-inf") if end is None else (total + end) / (len(value) + 1)


def learn(values: Sequence[str]) -> Automaton:
    tree = PrefixTree([symbols(v) for v in sorted(values)])
    tree.infer()
    arcs, ends = {}, {}
    for state in tree.settled:
        of = tree.passes[state]
        for symbol, to in tree.arcs[state].items():
            arcs[state, symbol] = (to, log(tree.taken[state][symbol] / of / CLASS_SIZE.get(symbol, 1)))
        if tree.ends[state]:
            ends[state] = log(tree.ends[state] / of)
    scored = sorted(Automaton(arcs, ends, 0.0).score(v) for v in values)
    return Automaton(arcs, ends, scored[int((1 - REACHED) * len(scored))])


class Ordinary:
    """Log likelihood of a character in ordinary runs: pairs of letters, backed off to letters."""

    def __init__(self, runs: Sequence[str]):
        self.pairs: dict[str, int] = defaultdict(int)
        self.firsts: dict[str, int] = defaultdict(int)
        self.letters: dict[str, int] = defaultdict(int)
        for run in runs:
            for a, b in zip("\n" + run, run + "\n"):
                self.pairs[a + b] += 1
                self.firsts[a] += 1
                self.letters[b] += 1
        self.total = sum(self.letters.values())

    def score(self, value: str) -> float:
        total = 0.0
        for a, b in zip("\n" + value, value + "\n"):
            letter = (self.letters.get(b, 0) + 1) / (self.total + 68)
            total += log((self.pairs.get(a + b, 0) + 8 * letter) / (self.firsts.get(a, 0) + 8))
        return total / (len(value) + 1)


@dataclass(frozen=True)
class Model:
    automata: dict[str, Automaton]
    ordinary: Ordinary

    def worth(self, value: str) -> float:
        """How far the best automaton takes the value for its format; negative: none does."""
        best = float("-inf")
        for automaton in self.automata.values():
            likely = automaton.score(value)
            if likely >= automaton.passing:
                best = max(best, likely)
        return best - self.ordinary.score(value) if best > float("-inf") else best


def samples(docs: DataFrame, text: str = "text", sample: int = SAMPLE, ordinary: int = ORDINARY) -> dict[str, list[str]]:
    """The labelled values per kind, at most ``sample`` each, and ``ordinary`` other runs."""
    rows = docs.select(or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found, runs = set(), set()
            for t in part.column("text").to_pylist():
                found.update((kind, value) for kind, _, _, value in base_spans(t))
                runs.update(RUN.findall(t))
            # No other run of the slice can be among the smallest of all.
            found.update((PLAIN, v) for _, v in nsmallest(ordinary, ((crc32(v.encode()), v) for v in runs)))
            kinds, values = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])

    schema = StructType([StructField("kind", StringType()), StructField("value", StringType())])
    values = rows.mapInArrow(run, schema).groupBy("kind", "value").agg(F.first(F.crc32(F.col("value").cast("binary"))).alias("h"))
    values = stage(values, "samples")
    by_kind: dict[str, list[str]] = defaultdict(list)
    for chosen, count in ((values.where(F.col("kind") != PLAIN), sample), (values.where(F.col("kind") == PLAIN), ordinary)):
        for row in smallest(chosen, "kind", [F.col("h"), F.col("value")], count).collect():
            by_kind[row.kind].append(row.value)
    return dict(by_kind)


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, ordinary: int = ORDINARY) -> Model:
    found = samples(docs, text, sample, ordinary)
    plain = Ordinary(found.pop(PLAIN, []))
    return Model({kind: learn(values) for kind, values in found.items()}, plain)


def found_spans(text: str, base: Sequence[tuple], worth: Callable[[str], float]) -> list[tuple[int, int, float]]:
    """Candidates outside base spans that are taken for a learned format.

    A dot at either end of a run counts as the sentence's where the run alone passes
    without it.
    """
    found = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for _, s, e, _ in base):
            continue
        inner = m[0].strip(".")
        for value, at in ((inner, start + m[0].find(inner) if inner else start), (m[0], start)):
            if len(value) >= ASSIGN_LEAST and (best := worth(value)) >= 0:
                found.append((at, at + len(value), best))
                break
    return found


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``found`` spans (kind, start, end in code points) of every row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = lru_cache(maxsize=KNOWN_CANDIDATES)(model.worth)
        for part in slices(batches):
            base, found = [], []
            for t in part.column("text").to_pylist():
                own = base_spans(t)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e, _ in own])
                more = found_spans(t, own, worth) if model.automata else []
                found.append([{"kind": FOUND, "start": s, "end": e} for s, e, _ in more])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(base, span), pa.array(found, span)], ["doc_id", "base", "found"]
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, base {SPANS}, found {SPANS}")
