"""Token counts by a map-side lookup in two tiers.

A byte-level tokenizer cuts a text into pre-tokens and encodes each by itself,
so a text has as many tokens as its pre-tokens have together.

* First tier: the most frequent pre-tokens with their lengths, packed into one
  byte string and broadcast.  They are found by a mergeable top-k sketch over a
  bounded sample of rows.  The sample decides what is fast, never what is right.
* Second tier: a pre-token outside the first tier is encoded once per worker by
  the tokenizer's own library and kept in that worker's cache, which is emptied
  to the first tier when it is full.

Texts are counted where they lie: no row and no pre-token is shuffled.

Defined cases: a null text is empty and has 0 tokens and 0 bytes.  Repeated rows
are counted each for itself.  A text of any length is split whole, and a long
pre-token is counted without being kept.  Null ids stay.  Other columns, also
ones named like the results, are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.bpe import WORD_PATTERN, read_vocabulary
from strata.llm.common import or_empty, slices

# First tier: at most so many pre-tokens of at most so many characters, so the
# broadcast stays below FREQUENT * (4 * FREQUENT_CHARS + 5) bytes.
FREQUENT = 10_000
FREQUENT_CHARS = 32
# Rows (about) and their largest text, in bytes, that the sketch reads.
SAMPLE_ROWS = 4_000
SAMPLE_BYTES = 1 << 16
TRACKED = 65_536

# Second tier: entries, and characters of the longest pre-token that is kept.
CACHED = 400_000
CACHED_CHARS = 64

# The word pattern as it reads for a text of ASCII only, where a simpler engine is faster.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"


class Splitter:
    """Cuts texts as a byte-level tokenizer file says; other kinds are refused."""

    def __init__(self, spec: str):
        form = json.loads(spec)
        before = form.get("pre_tokenizer") or {}
        if form["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or form.get("normalizer"):
            raise ValueError("only byte-level BPE files without normalizer and prefix space")
        added = form.get("added_tokens", [])
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take up white space or words are not supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.words = regex.compile(WORD_PATTERN).findall
        self.ascii_words = re.compile(ASCII_PATTERN).findall

    def parts(self, text: str) -> tuple[int, list[str]]:
        """How many special tokens stand in the text, and its pre-tokens."""
        if self.special is None or not self.special.search(text):
            return 0, self.ascii_words(text) if text.isascii() else self.words(text)
        pieces = self.special.split(text)
        return len(pieces) - 1, list(chain.from_iterable(map(self.words, pieces)))


class Lengths:
    """Token counts of pre-tokens: the broadcast tier and this worker's own."""

    def __init__(self, spec: str, packed: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.splitter = Splitter(spec)
        self.packed = packed
        self.known = unpack(packed)

    def encode(self, words: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def count(self, texts: Iterable[str]) -> list[int]:
        parts = [self.splitter.parts(t) for t in texts]
        words = set(chain.from_iterable(w for _, w in parts))
        misses = [w for w in words if w not in self.known]
        if len(self.known) + len(misses) > CACHED:
            self.known = unpack(self.packed)
            misses = [w for w in words if w not in self.known]
        found = dict(zip(misses, self.encode(misses)))
        long = {w: n for w, n in found.items() if len(w) > CACHED_CHARS}
        if long:
            table = self.known | found
        else:
            table = self.known
            table.update(found)
        counts = [special + sum(map(table.__getitem__, w)) for special, w in parts]
        if long:
            self.known.update((w, n) for w, n in found.items() if w not in long)
        return counts


def pack(lengths: dict[str, int]) -> bytes:
    """Pre-tokens with their lengths: per entry its size, its length, its bytes."""
    raw = ((w.encode(), n) for w, n in lengths.items())
    return b"".join(len(w).to_bytes(1) + n.to_bytes(2) + w for w, n in raw)


def unpack(packed: bytes) -> dict[str, int]:
    table, at = {}, 0
    while at < len(packed):
        end = at + 3 + packed[at]
        table[packed[at + 3 : end].decode()] = int.from_bytes(packed[at + 1 : at + 3])
        at = end
    return table


@lru_cache(maxsize=1)
def _lengths(spec: str, packed: bytes) -> Lengths:
    return Lengths(spec, packed)


def frequent(docs: DataFrame, spec: str, text: str = "text", count: int = FREQUENT) -> bytes:
    """The packed first tier: about the ``count`` most frequent pre-tokens of a sample of rows."""
    rows = docs.count()
    sample = docs.sample(min(1.0, SAMPLE_ROWS / rows), seed=7) if rows else docs
    whole = sample.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    words = whole.select(F.explode(F.regexp_extract_all("text", F.lit("(?U)()" + WORD_PATTERN), F.lit(0))).alias("w"))
    top = words.where(F.length("w") <= FREQUENT_CHARS).agg(F.expr(f"approx_top_k(w, {count}, {TRACKED})").alias("top")).first()
    found = [r["item"] for r in top["top"] or []]
    return pack(dict(zip(found, Lengths(spec, b"").encode(found))))


def count_tokens(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row.

    Special tokens' strings inside a text count as the library takes them, as one
    token each; none is added.
    """
    spec = read_vocabulary(vocabulary_path)
    packed = frequent(docs, spec, text)
    context = docs.sparkSession.sparkContext
    tables = context.broadcast((spec, packed))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(*tables.value)
        for part in slices(batches):
            texts = part.column("text")
            n_bytes = pc.cast(pc.binary_length(texts), pa.int64())
            n_tokens = pa.array(lengths.count(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    schema = StructType([rows.schema["doc_id"], StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    return rows.mapInArrow(run, schema)
