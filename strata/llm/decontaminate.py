"""Benchmark decontamination by pigeonhole edit matching.

An item within ``k`` edits of a passage keeps one of any ``k + 1`` pieces of it
unchanged.  So each item is cut into its error budget plus one pieces, one
automaton finds the exact hits of all pieces in a text, and around the hits the
whole item is searched with Myers' bit-parallel edit distance.

Texts and items are compared lower-cased and with white space runs as one space.
The budget of an item is ``RATE`` of its length, but its pieces keep at least
``PIECE`` characters; an item too short for two pieces must occur unchanged.

Items are broadcast in blocks of about ``BLOCK_CHARS`` characters: a benchmark
of any size takes as many passes over the texts as it has blocks.  Texts are
searched whole, where they lie.

A null or empty text holds nothing, a null or empty item occurs nowhere.  Equal
items are reported each; repeated rows are searched each for itself; other
columns are ignored by ``find`` and passed through by ``drop``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty, slices

RATE = 0.1
PIECE = 12
BLOCK_CHARS = 4_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(length: int) -> int:
    return max(0, min(int(RATE * length), length // PIECE - 1))


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the budget-plus-one pieces, as equal in length as they can be."""
    parts = budget(len(item)) + 1
    edges = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


class Pattern:
    """One item with its bit masks for Myers' algorithm, forwards and backwards."""

    def __init__(self, text: str):
        self.text, self.size, self.budget = text, len(text), budget(len(text))
        self.masks, self.back = defaultdict(int), defaultdict(int)
        for i, c in enumerate(text):
            self.masks[c] |= 1 << i
            self.back[c] |= 1 << (self.size - 1 - i)

    def _distances(self, masks: dict, text: str, anchored: bool) -> Iterator[int]:
        """After each character: the least distance of the item and a part of ``text`` ending
        there; with ``anchored`` that part begins where ``text`` begins."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score, first = full, 0, self.size, int(anchored)
        for c in text:
            same = masks.get(c, 0)
            vertical = same | down
            horizontal = (((same & up) + up) ^ up) | same
            more = down | ~(horizontal | up) & full
            less = up & horizontal
            if more & top:
                score += 1
            elif less & top:
                score -= 1
            more = (more << 1 | first) & full
            less = less << 1 & full
            up = (less | ~(vertical | more)) & full
            down = more & vertical
            yield score

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, distance) of the best match of each run of ends within the budget."""
        found, best = [], None
        for i, d in enumerate(self._distances(self.masks, text, False)):
            if d <= self.budget:
                if best is None or d < best[1]:
                    best = (i + 1, d)
            elif best:
                found.append(best)
                best = None
        if best:
            found.append(best)
        placed = []
        for end, distance in found:
            before = text[max(0, end - self.size - distance) : end][::-1]
            for length, d in enumerate(self._distances(self.back, before, True), 1):
                if d == distance:
                    placed.append((end - length, end, distance))
                    break
        return placed


def _apart(text: str, at: int) -> bool:
    """Whether no word goes on over this place."""
    return not (0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum())


class Matcher:
    def __init__(self, items: list[tuple]):
        """``items``: (id, normalised text)."""
        self.ids = [i for i, _ in items]
        self.patterns = [Pattern(t) for _, t in items]
        owners = defaultdict(list)
        for n, (_, text) in enumerate(items):
            for offset, piece in pieces(text):
                owners[piece].append((n, offset, len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, where)
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, start, end, distance) of all matches in a normalised text."""
        if not self.patterns or not text:
            return []
        begins = defaultdict(list)
        for last, where in self.automaton.iter(text):
            for n, offset, length in where:
                begins[n].append(last + 1 - length - offset)
        found = []
        for n, starts in begins.items():
            pattern = self.patterns[n]
            reach = pattern.size + pattern.budget
            window: list[int] = []
            for at in sorted(set(starts)):
                low, high = at - pattern.budget, at + reach
                if window and low <= window[1]:
                    window[1] = high
                    continue
                if window:
                    found += self._within(n, text, *window)
                window = [low, high]
            found += self._within(n, text, *window)
        return found

    def _within(self, n: int, text: str, low: int, high: int) -> list[tuple[int, int, int, int]]:
        low = max(0, low)
        found = [(n, low + s, low + e, d) for s, e, d in self.patterns[n].search(text[low:high])]
        # A short item that takes no error must stand as words: "yes" is not in "yesterday".
        return found if self.patterns[n].budget else [f for f in found if _apart(text, f[1]) and _apart(text, f[2])]


@lru_cache(maxsize=2)
def _matcher(items: tuple) -> Matcher:
    return Matcher(list(items))


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[tuple]:
    """The items in blocks of bounded size, each as a tuple of (id, normalised text)."""
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), or_empty(text).alias("text")).where(F.trim("text") != "")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_CHARS)
    for block in range(blocks):
        own = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block)
        found = sorted(((r.item_id, normal(r.text)) for r in own.collect()), key=repr)
        yield tuple((i, t) for i, t in found if t)


def find(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """A row per text and item found in it: ``doc_id``, ``item_id``, ``distance``, ``start``, ``end``, ``places``.

    Distance and place (in the normalised text) are of the best match, the first
    of equal ones; ``places`` counts the matches.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    item_type = items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, distance int, start bigint, `end` bigint, places int"
    parts = []
    for block in item_blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value)
            for part in slices(batches):
                ids = part.column("doc_id").to_pylist()
                out = []
                for i, t in zip(ids, part.column("text").to_pylist()):
                    by_item = defaultdict(list)
                    for n, start, end, distance in matcher.find(normal(t)):
                        by_item[n].append((distance, start, end))
                    for n, places in by_item.items():
                        distance, start, end = min(places)
                        out.append((i, matcher.ids[n], distance, start, end, len(places)))
                types = [part.schema.field("doc_id").type, None, pa.int32(), pa.int64(), pa.int64(), pa.int32()]
                names = ["doc_id", "item_id", "distance", "start", "end", "places"]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        parts.append(rows.mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts)


def drop(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose text holds no item."""
    for block in item_blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value)
            for part in slices(batches, text):
                clean = [not matcher.find(normal(t or "")) for t in part.column(text).to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
