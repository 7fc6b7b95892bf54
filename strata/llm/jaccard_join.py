"""N-gram Jaccard join by MinHash banding.

1. Equal texts are one class; the class is the node of everything that follows,
   so copies are never paired.
2. Each class gets a MinHash signature of its word n-grams, cut into bands.  Band
   and row counts follow from the similarity and the recall asked for.  Classes
   are shuffled on band hashes; the smallest class of a bucket is its pivot.
3. Members of a pivot's buckets are compared on their full n-gram sets, in blocks
   of bounded size, by counting shared n-grams with matrix products.  Pairs are
   counted where both classes are first brought together and are not written out:
   a block gives each class its number of partners and a representative of the
   partners it found.
4. Representatives are joined to components by passing on the smallest label.

Words are split at white space and lower-cased.  A text of fewer words than
``n`` has one gram, all of its words; one without a word (null, empty, blank) is
like nothing and alone in its class.  Two texts are linked if the Jaccard
similarity of their sets of word n-grams is at least ``similarity``.
Repeated rows are copies of each other.  Other columns are ignored by ``join``
and passed through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import numbered, or_empty, slices, stage

N = 5
SIMILARITY = 0.8
RECALL = 0.99999
MOST_HASHES = 96
# Bounds of one block of a pivot's members: classes, and n-grams of all of them.
BLOCK_ROWS, BLOCK_GRAMS = 768, 1_000_000
COLUMNS = 8192


def bands_for(similarity: float, recall: float, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have so that ``recall`` is reached.

    More rows make chance meetings rarer; a pair at ``similarity`` s meets in one
    of b bands of r rows with probability 1 - (1 - s^r)^b.
    """
    best = None
    for rows in range(1, most_hashes + 1):
        missed = 1 - similarity**rows
        if missed >= 1:
            break
        bands = 1 if missed <= 0 else ceil(log(1 - recall) / log(missed))
        if bands * rows <= most_hashes:
            best = bands, rows
    if best is None:
        raise ValueError(f"recall {recall} at similarity {similarity} takes more than {most_hashes} hashes")
    return best


_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit of the input over the output."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


class Grams:
    """N-gram hashes of texts; keeps the hashes of words seen so far."""

    KEPT = 500_000

    def __init__(self, n: int):
        self.n, self.words = n, {}

    def _hashes(self, words: list[str]) -> np.ndarray:
        known = self.words
        if len(known) > self.KEPT:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = int.from_bytes(blake2b(w.encode(), digest_size=8).digest(), "little")
            out.append(h)
        return np.array(out, dtype=np.uint64)

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the text's n-grams."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        hashes = self._hashes(words)
        size = min(self.n, len(words))
        count = len(words) - size + 1
        total = np.full(count, np.uint64(size), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                total = mix(total * _MIX[0] + hashes[k : k + count])
        return np.unique(total)


def seeds_of(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * _MIX[0])


def band_hashes(grams: np.ndarray, seeds: np.ndarray, bands: int) -> list[int]:
    """One signed 64-bit hash per band, of the band's number and its minima."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, dtype=np.uint64)
    odd = (seeds | np.uint64(1))[:, None]
    with np.errstate(over="ignore"):
        for at in range(0, len(grams), COLUMNS):
            # Multiplying by an odd number and folding the halves is a permutation good enough to rank by.
            x = (grams[None, at : at + COLUMNS] ^ seeds[:, None]) * odd
            x ^= x >> np.uint64(32)
            np.minimum(least, x.min(axis=1), out=least)
        rows = len(seeds) // bands
        total = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for column in least.reshape(bands, rows).T:
            total = mix(total * _MIX[0] + column)
    return total.view(np.int64).tolist()


# A character that is no white space for ``str.split``, by which words are cut.
A_WORD = r"(?U)[^\s\x1C-\x1F]"


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def signatures(docs: DataFrame, doc_id: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``key`` of the text and its ``bands`` (none for a text without words)."""
    df = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"))
    df = df.select("doc_id", _key(F.col("text")).alias("key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, seeds = Grams(n), seeds_of(bands * rows)
        for part in slices(batches):
            found = []
            for t in part.column("text").to_pylist():
                own = grams.of(t)
                found.append(band_hashes(own, seeds, bands) if len(own) else [])
            columns = [part.column("doc_id"), part.column("key"), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "bands"])

    id_type = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(run, f"doc_id {id_type}, key binary, bands array<bigint>")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share.  Elements of one set only take no part."""
    size = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(size), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    length = np.diff(np.concatenate([start, [len(values)]]))
    column = np.repeat(np.cumsum(length > 1) - 1, length)
    common = np.repeat(length > 1, length)
    owner, column = owner[common], column[common]
    shared = np.zeros((size, size), dtype=np.float32)
    # Columns come in order, so a slice of them is a slice of the arrays.
    last = int(column[-1]) + 1 if len(column) else 0
    edges = np.searchsorted(column, np.arange(0, last + COLUMNS, COLUMNS))
    for block, (a, b) in enumerate(zip(edges, edges[1:])):
        if a < b:
            holds = np.zeros((size, min(COLUMNS, last - block * COLUMNS)), dtype=np.float32)
            holds[owner[a:b], column[a:b] - block * COLUMNS] = 1
            shared += holds @ holds.T
    return shared


def _links_of(cell: pa.Table, similarity: float) -> tuple[np.ndarray, list[bytes], list[int], list[int], list[bytes]]:
    """Of one cell (two blocks of a pivot's members): per member its key, its numbers of linked
    classes and documents, and the smallest class it reaches over the cell's links."""
    row, column = cell.column("row_block")[0].as_py(), cell.column("column_block")[0].as_py()
    keys = cell.column("key").to_pylist()
    block = np.array(cell.column("block").to_pylist())
    sets = [np.array(g.as_py(), dtype=np.int64) for g in cell.column("grams")]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    documents = np.array(cell.column("documents").to_pylist(), dtype=np.int64)
    shared = shared_counts(sets).astype(np.float64)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= similarity * union - 1e-9
    np.fill_diagonal(linked, False)
    if row != column:
        # Pairs inside a block are counted in the block's own cell.
        linked &= block[:, None] != block[None, :]
    # A pair with a smaller pivot in common is counted there.
    pivots = [p.as_py() for p in cell.column("earlier")]
    names = {p: i for i, p in enumerate(sorted({p for own in pivots for p in own}))}
    if names:
        has = np.zeros((len(keys), len(names)), dtype=np.float32)
        for i, own in enumerate(pivots):
            has[i, [names[p] for p in own]] = 1
        counted = linked & ((has @ has.T) == 0)
    else:
        counted = linked
    order = sorted(range(len(keys)), key=keys.__getitem__)
    rank = np.empty(len(keys), dtype=np.int64)
    rank[order] = np.arange(len(keys))
    label = rank.copy()
    while True:
        around = np.minimum(label, np.where(linked, label[None, :], len(keys)).min(axis=1))
        if (around == label).all():
            break
        label = around
    least = [keys[order[x]] for x in label]
    return keys, counted.sum(axis=1).tolist(), (counted @ documents).tolist(), least


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``key``, ``label``: the smallest key that can be reached over ``edges`` (a, b).

    Each round takes the least label around and then the label's own label, so
    the rounds grow with the logarithm of a component's width.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(nodes.select("key", F.col("key").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        taken = labels.join(near, labels["key"] == near["a"], "left").select("key", "label", F.least("label", "near").alias("new"))
        # The label is itself a node: follow it one step.
        jump = labels.select(F.col("key").alias("new"), F.col("label").alias("next"))
        moved = stage(
            taken.join(jump, "new", "left").select("key", F.col("label").alias("old"), F.least("new", "next").alias("label")),
            "labels",
        )
        if moved.where(F.col("label") != F.col("old")).isEmpty():
            return moved.select("key", "label")
        labels = moved.select("key", "label")


def classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, similarity: float = SIMILARITY, recall: float = RECALL
) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc_id``, ``key``, ``blank``) and linked classes (``key``, ``label``, ``texts``, ``documents``)."""
    bands, rows = bands_for(similarity, recall)
    signed = stage(signatures(docs, doc_id, text, n, bands, rows), "signatures")
    members = signed.select("doc_id", "key", (F.size("bands") == 0).alias("blank"))
    texts = signed.where(F.size("bands") > 0)
    nodes = texts.groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("first"))
    # Rows of one key have one signature, so a band's row is repeated by copies; grouping by band and key removes that.
    banded = texts.select("key", F.explode("bands").alias("band")).distinct()
    buckets = banded.groupBy("band").agg(F.min("key").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    met = stage(banded.join(buckets, "band").select("key", "pivot").distinct(), "met")

    # Blocks of each pivot by rows and by n-grams; the latter are known only from the texts.
    wanted = met.groupBy("key").agg(F.sort_array(F.collect_list("pivot")).alias("pivots")).join(nodes, "key")
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"))
    source = source.withColumn("key", _key(F.col("text")))
    first = wanted.select(F.col("key").alias("k"), "first", "pivots", "documents")
    chosen = source.join(first, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("first"))).drop("k", "first", "doc_id")

    def gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(n)
        for part in slices(batches):
            sets = pa.array([grams.of(t).view(np.int64) for t in part.column("text").to_pylist()], pa.list_(pa.int64()))
            columns = [part.column(c) for c in ("key", "pivots", "documents")]
            yield pa.RecordBatch.from_arrays([*columns, sets], ["key", "pivots", "documents", "grams"])

    sets = chosen.select("key", "pivots", "documents", "text").mapInArrow(
        gram_rows, "key binary, pivots array<binary>, documents bigint, grams array<bigint>"
    )
    # A doc_id that occurs twice with one text gives the set twice.
    sets = stage(sets.dropDuplicates(["key"]), "grams")
    placed = sets.select("key", "pivots", "documents", "grams", F.explode("pivots").alias("pivot"))
    blocks = (
        sets.select(F.explode("pivots").alias("pivot"), F.size("grams").alias("grams"))
        .groupBy("pivot")
        .agg(
            F.greatest(
                F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("grams") / BLOCK_GRAMS), F.lit(1)
            ).cast("int").alias("blocks")
        )
    )
    block = F.pmod(F.xxhash64("key", "pivot"), F.col("blocks")).cast("int")
    cells = (
        placed.join(blocks, "pivot")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "pivot",
            F.least("block", "other").alias("row_block"),
            F.greatest("block", "other").alias("column_block"),
            "block",
            "key",
            "documents",
            "grams",
            F.filter("pivots", lambda p: p < F.col("pivot")).alias("earlier"),
        )
    )

    def compare(cell: pa.Table) -> pa.Table:
        keys, texts, documents, least = _links_of(cell, similarity)
        return pa.table(
            {"key": pa.array(keys, pa.binary()), "texts": pa.array(texts, pa.int64()), "documents": pa.array(documents, pa.int64()), "least": pa.array(least, pa.binary())}
        )

    # Dealt by the whole cell: a large pivot's cells go to different tasks.
    found = cells.repartition("pivot", "row_block", "column_block").groupBy("pivot", "row_block", "column_block").applyInArrow(
        compare, "key binary, texts bigint, documents bigint, least binary"
    )
    found = stage(found, "links")
    counts = found.groupBy("key").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    edges = found.where(F.col("least") != F.col("key")).select(F.col("key").alias("a"), F.col("least").alias("b"))
    nodes_with = edges.select(F.col("a").alias("key")).union(edges.select("b")).distinct()
    return members, components(nodes_with, edges).join(counts, "key")


def join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``class_id``, ``n_copies``, ``n_linked_texts``, ``n_links``.

    ``class_id`` is the smallest id of the documents reached over links; copies
    are other documents with the same text, linked texts are different texts
    similar enough, and links are all other documents that are copies of the text
    or of a linked text.
    """
    members, linked = classes(docs, doc_id, text, n, similarity, recall)
    sizes = members.where(~F.col("blank")).groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("first"))
    labelled = sizes.join(linked, "key", "left").withColumn("label", F.coalesce("label", "key"))
    labelled = stage(labelled, "labelled")
    named = labelled.groupBy("label").agg(F.min("first").alias("class_id"))
    by_key = labelled.join(named, "label").select("key", "class_id", "size", "texts", "documents")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return members.join(by_key, "key", "left").select(
        "doc_id",
        F.when(F.col("blank"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        zero(F.col("size") - 1).alias("n_copies"),
        zero(F.col("texts")).alias("n_linked_texts"),
        (zero(F.col("size") - 1) + zero(F.col("documents"))).alias("n_links"),
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """The rows of ``docs``, unchanged, with one left of each class: the one with the smallest id.

    Rows without a word are in no class and all stay.
    """
    members, linked = classes(docs, doc_id, text, n, similarity, recall)
    sizes = members.where(~F.col("blank")).groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("first"))
    labelled = sizes.join(linked.select("key", "label"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    chosen = labelled.groupBy("label").agg(F.min(F.struct("first", "key")).alias("one"))
    chosen = chosen.select(F.col("one.key").alias("_key"), F.col("one.first.doc_id").alias("_id"))
    chosen = stage(chosen, "chosen")
    rows, (own_id, own_text) = numbered(docs, doc_id, text)
    own = rows.withColumn("_own", _key(or_empty(own_text))).withColumn("_blank", ~or_empty(own_text).rlike(A_WORD))
    same = (F.col("_own") == F.col("_key")) & F.col(own_id).eqNullSafe(F.col("_id")) & ~F.col("_blank")
    kept = own.where(~F.col("_blank")).join(chosen, same).drop("_blank", "_key", "_id")
    # Rows repeated in full share id and text.
    kept = kept.dropDuplicates([own_id, "_own"]).drop("_own")
    return kept.unionByName(own.where("_blank").drop("_own", "_blank")).toDF(*docs.columns)
