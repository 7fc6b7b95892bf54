"""Byte-pair encoding and decoding by a trie of the distinct words.

For a fixed merge list the encoding of a text has one property the traversal
uses: the last token of the encoding of every prefix is fixed, and what stands
before that token is the encoding of the shorter prefix.  So a trie node needs
only the last token of its path and the node where that token begins.  Going
depth-first, a node's last token is the one token that ends there and that stays
apart from the last token of the node it begins at.  What words of a slice share
as a prefix is worked out once.

Rows are encoded where they lie: no shuffle, one slice of texts at a time, and a
word table per Python worker that is emptied when it reaches ``CACHED_WORDS``.

Null texts are read as empty; an empty text has no tokens.  Repeated rows are
encoded each for itself; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from strata.llm.common import or_empty, slices

CACHED_WORDS = 700_000
KNOWN_PAIRS = 1_000_000
MAX_VOCABULARY_BYTES = 64 << 20

# Fixed value: the word pattern of byte-level tokenizers.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary file writes for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters = byte_letters()
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.pieces = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if t not in self.special}
        self.shown = self.pieces | {i: t.encode() for t, i in self.special.items()}
        size = max(self.shown, default=-1) + 1
        self.rank = [-1] * size
        self.left, self.right = [0] * size, [0] * size
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            a, b, made = (model["vocab"][t] for t in (first, second, first + second))
            if self.rank[made] >= 0:
                raise ValueError(f"two merges make {first + second!r}")
            self.pairs[a, b] = rank
            self.rank[made], self.left[made], self.right[made] = rank, a, b
        # A token counts where its own bytes encode to it.
        sound: dict[int, bool] = {}
        for i in sorted(self.pieces, key=lambda i: self.rank[i]):
            sound[i] = self.rank[i] < 0 and len(self.pieces[i]) == 1 or (
                self.rank[i] >= 0
                and sound[self.left[i]]
                and sound[self.right[i]]
                and self.apart(self.left[i], self.right[i], self.rank[i])
            )
        self.ids = {self.pieces[i]: i for i in self.pieces if sound[i]}
        # Lengths, longest first, of the tokens that end with three given bytes.
        lengths: dict[bytes, set[int]] = {}
        for piece in self.ids:
            if len(piece) >= 3:
                lengths.setdefault(piece[-3:], {2, 1}).add(len(piece))
        self.tails = {tail: tuple(sorted(own, reverse=True)) for tail, own in lengths.items()}
        self.known: dict[tuple[int, int], bool] = {}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(WORD_PATTERN)

    def apart(self, a: int, b: int, before: float = float("inf")) -> bool:
        """Whether no merge earlier than ``before`` reaches over the border of a and b.

        The later of the two tokens' own merges is undone first, so the pieces at
        the border are seen in reverse order of time.  Among equal ranks the
        leftmost pair merges first.
        """
        while True:
            over = self.pairs.get((a, b))
            if over is not None and over < before:
                return False
            rank_a, rank_b = self.rank[a], self.rank[b]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                before, a = rank_a, self.right[a]
            else:
                before, b = rank_b + 1, self.left[b]

    def compatible(self, a: int, b: int) -> bool:
        found = self.known.get((a, b))
        if found is None:
            if len(self.known) >= KNOWN_PAIRS:
                self.known.clear()
            found = self.known[a, b] = self.apart(a, b)
        return found


@lru_cache(maxsize=2)
def _vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


def encode_words(words: Sequence[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """The token ids of distinct words, by one depth-first walk over their trie.

    Sorted words are their trie in depth-first order: the nodes a word adds follow
    those of the branch it shares with the word before.  So the walk keeps the
    current branch only: per depth the last token of the path, and where it begins.
    """
    ids, tails, known = vocabulary.ids, vocabulary.tails, vocabulary.known
    found: list[list[int]] = [[]] * len(words)
    last, begins = [-1], [0]
    before = b""
    for i in sorted(range(len(words)), key=words.__getitem__):
        word = words[i]
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del last[shared + 1 :], begins[shared + 1 :]
        for depth in range(shared + 1, len(word) + 1):
            # The one token that ends here and stays apart from the last one where it begins.
            for length in tails.get(word[max(depth - 3, 0) : depth], (2, 1)):
                start = depth - length
                if start < 0:
                    continue
                token = ids.get(word[start:depth])
                if token is None:
                    continue
                if start:
                    pair = last[start], token
                    apart = known.get(pair)
                    if not (vocabulary.compatible(*pair) if apart is None else apart):
                        continue
                last.append(token)
                begins.append(start)
                break
            else:
                raise ValueError(f"the vocabulary has no token for byte {word[depth - 1]}")
        tokens, at = [], len(word)
        while at:
            tokens.append(last[at])
            at = begins[at]
        tokens.reverse()
        found[i] = tokens
        before = word
    return found


class Encoder:
    """Encodes texts; keeps the ids of the words seen so far as packed integers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.packed: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        words, split = self.vocabulary.words, self.vocabulary.split
        if split is None or not any(s in text for s in self.vocabulary.special):
            return words.findall(text)
        parts = split.split(text)
        return list(chain.from_iterable([p] if i % 2 else words.findall(p) for i, p in enumerate(parts)))

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.packed]
        if len(self.packed) + len(new) > CACHED_WORDS:
            self.packed.clear()
            new = list(words)
        special = self.vocabulary.special
        self.packed.update((w, array("i", [special[w]]).tobytes()) for w in new if w in special)
        new = [w for w in new if w not in special]
        ids = encode_words([w.encode() for w in new], self.vocabulary)
        self.packed.update((w, array("i", i).tobytes()) for w, i in zip(new, ids))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        packed = self.packed
        return [b"".join([packed[w] for w in words]) for words in split]


@lru_cache(maxsize=1)
def _encoder(text: str) -> Encoder:
    return Encoder(_vocabulary(text))


def read_vocabulary(path: str) -> str:
    """A vocabulary file's text; its size is bounded by its kind, and checked."""
    with open(path, encoding="utf-8") as file:
        text = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} characters")
    return text


def _lists(packed: Sequence[bytes]) -> pa.Array:
    sizes = np.fromiter((len(p) // 4 for p in packed), dtype=np.int64, count=len(packed))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


def encode(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of token ids) of every row."""
    spec = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value)
        for part in slices(batches):
            packed = encoder.encode(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(packed)], ["doc_id", "ids"])

    schema = StructType([rows.schema["doc_id"], StructField("ids", ArrayType(IntegerType()))])
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the text of its ``ids``.

    Special tokens are written as they are; ids outside the vocabulary are left
    out; bytes that are no UTF-8 become replacement characters.  Null ids: null.
    """
    spec = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = _vocabulary(spec.value).shown
        pieces = [shown.get(i, b"") for i in range(max(shown, default=-1) + 1)]
        size = len(pieces)
        for batch in batches:
            column = batch.column("ids")
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
            inside = (flat >= 0) & (flat < size)
            texts = []
            for valid, a, b in zip(column.is_valid().to_pylist(), offsets, offsets[1:]):
                own = flat[a:b] if inside[a:b].all() else flat[a:b][inside[a:b]]
                texts.append(b"".join([pieces[i] for i in own.tolist()]).decode("utf-8", "replace") if valid else None)
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "decoded"]
            names = [n for n in batch.schema.names if n != "decoded"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, "decoded"])

    fields = [f for f in encoded.schema.fields if f.name != "decoded"]
    return encoded.mapInArrow(run, StructType([*fields, StructField("decoded", StringType())]))
