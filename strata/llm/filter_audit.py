"""What each filter of a chain removes, under every order of the filters.

Every document is reduced to a mask: one bit for each filter that it fails.  A
cell is a part of the corpus with one mask, its number of documents, and how many
of them carry each mark.  There are at most 2 ** filters cells in a part, however
many documents it holds, and only cells are folded:

* a cell runs through all orders at once: ``transform`` over the constant array of
  orders, ``aggregate`` along each order with the state "still there", which gives
  one struct of weighted counts for each (order, step);
* the structs of a part's cells are summed element by element.

Copies of an earlier document are found without bringing a group of copies into
one task: the smallest id of each text is a partial aggregate, and a document
looks itself up by (text digest, id), a key that copies do not share.

Defined cases: a null text is empty.  A null part is the empty string.  A row
without an id has no label and is no copy of another; rows with the same id and
text are no copies of each other.  Several labels of an id count as having each
value that one of them has; null labels are none.  Texts of any length are read
whole.  Other columns, whatever their names, are not read.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
WORD_BREAK = r"[\x20\x09-\x0D]+"


def standard_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text alone."""
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    n_words = F.size(words)
    return {
        "A": n_words < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n_words,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def bit(fails: Column, place: int) -> Column:
    return F.when(fails, F.lit(1 << place)).otherwise(F.lit(0))


def masks(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` and the number ``n`` of documents alike in them.

    The mask's bits are the standard filters in order, then that of copies.
    """
    whole = or_empty(text)
    own = standard_filters(whole)
    alone = sum((bit(fails, i) for i, fails in enumerate(own.values())), F.lit(0))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), or_empty(part).alias("part"), alone.alias("alone"), F.sha2(whole.cast("binary"), 256).alias("digest")
    )
    # Repeated rows become one with a count, so no key of the joins is hot.
    rows = rows.groupBy("id", "part", "alone", "digest").agg(F.count(F.lit(1)).alias("n"))
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).where(F.col("id").isNotNull()).withColumn("first", F.lit(True))
    marks = (
        labels.select(F.col("doc_id").alias("id"), "quality", "toxic")
        .groupBy("id")
        .agg(*[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))])
        .where((F.col("good") + F.col("toxic")) > 0)
    )
    copies = bit(F.col("id").isNotNull() & F.col("first").isNull(), len(own))
    none = F.lit(0)
    return (
        rows.join(firsts, ["digest", "id"], "left")
        .join(marks, "id", "left")
        .groupBy("part", (F.col("alone") + copies).alias("mask"), F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))
        .agg(F.sum("n").alias("n"))
    )


def folded(orders: Column) -> Column:
    """One struct of counts for each (order, step), for the row's cell.

    ``orders`` has the filters' bits in order.  The cell is in the columns
    ``mask``, ``n``, ``n_good`` and ``n_toxic``.
    """
    mask = F.col("mask")

    def step(state: Column, own: Column) -> Column:
        there, fails = state["there"], mask.bitwiseAND(own) != 0
        given = lambda when, n: F.when(when, F.col(n)).otherwise(F.lit(0).cast("bigint"))
        found = F.struct(
            given(there & ~fails, "n").alias("kept"),
            given(there & fails, "n").alias("removed"),
            given(~there & fails, "n").alias("redundant"),
            given(mask == own, "n").alias("unique_fails"),
            given(there & fails, "n_good").alias("good_lost"),
            given(there & fails, "n_toxic").alias("toxic_lost"),
        )
        return F.struct((there & ~fails).alias("there"), F.concat(state["steps"], F.array(found)).alias("steps"))

    nothing = F.array().cast("array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>")
    start = F.struct(F.lit(True).alias("there"), nothing.alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))


def audit(cells: DataFrame, letters: Sequence[str]) -> DataFrame:
    """A row per part, filter order and step, from ``part``, ``mask``, ``good``, ``toxic``, ``n``.

    ``shapley`` is what the step's filter removes, summed over all orders.
    """
    size = len(letters)
    chosen = list(permutations(range(size)))
    names = F.array(*[F.lit("".join(letters[i] for i in order)) for order in chosen])
    orders = F.array(*[F.array(*[F.lit(1 << i) for i in order]) for order in chosen])
    filters = F.flatten(F.array(*[F.array(*map(F.lit, order)) for order in chosen]))

    cells = cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"), F.sum(F.col("n") * F.col("toxic")).alias("n_toxic")
    )
    # A part has at most 2 ** filters cells, so this list is bounded.
    parts = cells.select("part", folded(orders).alias("folded")).groupBy("part").agg(F.collect_list("folded").alias("all"))
    sums = parts.select("part", F.aggregate(F.slice("all", 2, 1 << size), F.element_at("all", 1), added).alias("sums"))

    def share(own: int) -> Column:
        removed = F.zip_with("sums", filters, lambda x, i: F.when(i == own, x["removed"]).otherwise(0))
        return F.aggregate(removed, F.lit(0).cast("bigint"), lambda a, b: a + b)

    shares = F.array(*map(share, range(size)))
    place = F.col("place")
    return (
        sums.select("part", "sums", shares.alias("shares"))
        .select("part", "shares", F.posexplode("sums").alias("place", "counts"))
        .select(
            "part",
            F.get(names, F.floor(place / size).cast("int")).alias("filter_order"),
            (place % size + 1).cast("int").alias("step"),
            "counts.*",
            F.get("shares", F.get(filters, place)).alias("shapley"),
        )
    )
