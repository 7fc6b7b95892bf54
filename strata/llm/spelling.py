"""Groups of spellings: words one edit apart, and the word each stands for.

Words are counted per task before they are shuffled.  Two words are near if one
inserted, deleted or replaced code point makes them equal.

Search.  A word's length is cut into ``SEGMENTS`` parts.  The one edit of a near
pair lies in one of them, so the pair shares what is left and right of that part:
each word goes to the bucket of (length, part, what is left, what is right), as a
word of that length and as one that is a letter longer.  A bucket with more than
``BLOCK`` words is cut into blocks by hash, and each pair of its blocks is a cell
of its own; nothing is left out.  A near pair is counted in one cell alone: that
of the part in which the common prefix ends.

Comparison.  The words of a cell are two padded matrices of code points, one
flush left and one flush right.  Block against block, column by column, they
give the lengths of the common prefixes and suffixes of all pairs; where both
together reach the longer length minus one, the pair is near.  Cells of like size are
compared together.  Only what a word gathers in its cell leaves the task: how
many near words, and the best of them.

Defined cases: null and empty texts have no words; a null id counts as an empty
one.  Repeated rows count each.  Texts are read whole; a word of any length is
compared whole.  Ties between near words go to the first in code-point order.
Other columns, whatever their names, are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty, slices, stage

WORD_LETTERS = "a-zÀ-ÿ"
SEGMENTS = 3
BLOCK = 256
# Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 300_000
# Pairs that are compared at once.
TILE_PAIRS = 1 << 21
# Rows that are gathered before their cells are compared.
HELD_ROWS = 20_000


def count_words(
    docs: DataFrame,
    min_length: int = 6,
    min_count: int = 5,
    drop_one_in: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``word`` and ``n`` of every word that is long and frequent enough.

    With ``drop_one_in`` a document's word loses a code point where the checksum
    of "id:word" is divisible by that number.
    """
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), or_empty(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{WORD_LETTERS}]{{{min_length},}}").findall
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for part in slices(batches):
            ids, texts = part.column("id").to_pylist(), part.column("text").to_pylist()
            for own, raw in zip(ids, texts):
                # Of bytes, only A to Z have a lower case.
                found = find(raw.lower().decode())
                if drop_one_in is None:
                    held.update(found)
                    continue
                start = crc32(f"{own}:".encode())
                for word, n in Counter(found).items():
                    check = crc32(word.encode(), start)
                    if check % drop_one_in == 0:
                        at = check % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    held[word] += n
            if len(held) > HELD_WORDS:
                yield handed()
        yield handed()

    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ── search ─────────────────────────────────────────────────────────────────


def borders(size: Column, part: int) -> tuple[Column, Column]:
    """Where part ``part`` of a word of ``size`` letters begins and ends."""
    return F.floor(size * part / SEGMENTS).cast("int"), F.floor(size * (part + 1) / SEGMENTS).cast("int")


def in_buckets(words: DataFrame) -> DataFrame:
    """A row for each bucket of each word: ``word``, ``n``, ``size``, ``part``, ``bucket``."""
    length = F.length("word")

    def bucket(size: Column, part: int) -> Column:
        start, end = borders(size, part)
        left, right = F.col("word").substr(F.lit(1), start), F.col("word").substr(length - (size - end) + 1, size - end)
        return F.struct(size.alias("size"), F.lit(part).alias("part"), F.xxhash64(size, F.lit(part), left, right).alias("bucket"))

    own = F.array(*[bucket(size, part) for size in (length, length - 1) for part in range(SEGMENTS)])
    return words.select("word", "n", F.explode(own).alias("b")).select("word", "n", "b.*").where(F.col("size") > 0)


def dealt(rows: DataFrame) -> DataFrame:
    """Every row once for each cell of its bucket: ``a`` and ``b`` are the cell's blocks."""
    key = ["bucket", "size", "part"]
    # Buckets of more than a block are few; written down, their size is known to the planner.
    large = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BLOCK)
    large = stage(large.select(*key, F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")), "large-buckets")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = rows.join(large, key, "left").withColumn("own", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    every = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return every.select(
        "word", "n", *key, "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")
    )


def common(flush: np.ndarray) -> np.ndarray:
    """For matrices of shape (cells, rows, width): columns that all pairs of rows share from the first on."""
    cells, rows, width = flush.shape
    alive = np.ones((cells, rows, rows), bool)
    shared = np.zeros((cells, rows, rows), np.int32)
    for c in range(width):
        column = flush[:, :, c]
        alive &= column[:, :, None] == column[:, None, :]
        if not alive.any():
            break
        shared += alive
    return shared


def compare(words: np.ndarray, n: np.ndarray, size: np.ndarray, part: np.ndarray, own: np.ndarray, apart: np.ndarray, cell: np.ndarray):
    """Rows with a near word in their cell: row, how many near words, the best one's row.

    ``cell`` numbers the cells, ascending; ``apart`` marks cells of two blocks,
    where only words of different blocks (``own``) are compared.
    """
    lengths = np.char.str_len(words).astype(np.int32)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    counts = np.diff(np.append(first, len(cell)))
    # The best near word has the lowest rank.
    rank = np.empty(len(words), np.int64)
    rank[np.lexsort((words, -n))] = np.arange(len(words))
    at_rank = np.argsort(rank)
    found_rows, found_counts, found_best = [], [], []
    wide = 1 << np.ceil(np.log2(np.maximum(counts, 2))).astype(int)
    width_of = size[first] + 1
    # Cells of like size, and of like word length so that padding stays small.
    for rows, width in sorted(set(zip(wide[counts > 1].tolist(), width_of[counts > 1].tolist()))):
        chosen = np.flatnonzero((wide == rows) & (counts > 1) & (width_of == width))
        step = max(1, TILE_PAIRS // (rows * rows))
        for at in range(0, len(chosen), step):
            cells = chosen[at : at + step]
            index = first[cells][:, None] + np.arange(rows)
            there = np.arange(rows) < counts[cells][:, None]
            index = np.where(there, index, first[cells][:, None])
            sizes = np.where(there, lengths[index], -9)
            letters = np.ascontiguousarray(words[index].astype(f"U{width}")).view(np.uint32).reshape(len(cells), rows, width)
            shift = np.arange(width) - (width - sizes.clip(0))[:, :, None]
            right = np.where(shift >= 0, np.take_along_axis(letters, shift.clip(0), 2), 0)
            prefix, suffix = common(letters), common(right[:, :, ::-1])
            a, b = sizes[:, :, None], sizes[:, None, :]
            cell_size, cell_part = size[first[cells]][:, None, None], part[first[cells]][:, None, None]
            begins = np.minimum(prefix, cell_size - 1)
            near = (
                (prefix + suffix >= np.maximum(a, b) - 1)
                & (np.abs(a - b) <= 1)
                & (np.minimum(a, b) == cell_size)
                & (begins >= cell_size * cell_part // SEGMENTS)
                & (begins < cell_size * (cell_part + 1) // SEGMENTS)
                & ~np.eye(rows, dtype=bool)
            )
            blocks = own[index]
            near &= ~apart[first[cells]][:, None, None] | (blocks[:, :, None] != blocks[:, None, :])
            number = near.sum(2)
            best = np.where(near, rank[index][:, None, :], len(words)).min(2)
            hit = number > 0
            found_rows.append(index[hit])
            found_counts.append(number[hit])
            found_best.append(at_rank[best[hit]])
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return join(found_rows), join(found_counts), join(found_best)


NEAR = "word string, n_near bigint, best_n bigint, best string"


def compared(cells: DataFrame) -> DataFrame:
    """What each word gathers in each of its cells."""
    key = ["size", "part", "bucket", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(table: pa.Table) -> Iterator[pa.RecordBatch]:
            column = lambda name: table.column(name).to_numpy()
            size, a, b = column("size"), column("a"), column("b")
            change = np.zeros(len(size), bool)
            for name in key:
                change[1:] |= np.diff(column(name)) != 0
            words, n = np.array(table.column("word").to_pylist(), dtype=str), column("n")
            rows, counts, best = compare(words, n, size, column("part"), column("own"), a != b, np.cumsum(change))
            if len(rows):
                taken = table.column("word")
                yield pa.RecordBatch.from_arrays(
                    [taken.take(pa.array(rows)).combine_chunks(), pa.array(counts, pa.int64()), pa.array(n[best]), taken.take(pa.array(best)).combine_chunks()],
                    ["word", "n_near", "best_n", "best"],
                )

        held: list[pa.RecordBatch] = []
        rows = 0
        for part in slices(batches, "word"):
            held.append(part)
            rows += part.num_rows
            if rows < HELD_ROWS:
                continue
            table = pa.Table.from_batches(held)
            # The last cell may go on in the next batch.
            last = table.slice(rows - 1, 1)
            same = np.ones(rows, bool)
            for name in key:
                same &= table.column(name).to_numpy() == last.column(name).to_numpy()
            cut = int(np.argmax(same))
            if cut:
                yield from results(table.slice(0, cut))
            rest = table.slice(cut)
            held, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield from results(pa.Table.from_batches(held))

    ordered = cells.repartition(*[F.col(c) for c in key]).sortWithinPartitions(*key)
    return ordered.mapInArrow(run, NEAR)


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best`` and ``best_n`` of each word that has a near one."""
    found = compared(dealt(in_buckets(words)))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("top"))
        .select("word", "n_near", F.col("top.word").alias("best"), (-F.col("top.less")).alias("best_n"))
    )


def followed(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` from ``word`` and ``form``: forms are followed to the last.

    Each round doubles the way followed; counts grow along the way, so it ends.
    """
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(roots.join(onward, "root", "left"), "followed")
        roots = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return roots


def group(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word.

    A word's form is its most frequent near word, where that is ``ratio`` times as
    frequent as the word or more.  ``words`` is read several times.
    """
    near = stage(near_words(words), "near-words")
    enough = F.col("best_n") >= ratio * F.col("n")
    told = words.join(near, "word", "left").select(
        "word",
        F.when(enough, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, F.col("best_n")).alias("form_n"),
    )
    told = stage(told, "forms")
    roots = followed(told.where(F.col("form").isNotNull()))
    out = told.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
