"""Language identification with a blended-spectrum string kernel.

The kernel of two texts is the number of character n-grams (one to ``LONGEST``
characters) that both hold, over the geometric mean of how many each holds.
Landmark texts (Nyström) turn it into a bounded feature vector, and one ridge
regression per language on those vectors gives the scores.  A batch of texts is
scored by matrix products.

Landmarks and training rows are bounded samples of the labelled rows given: per
language the rows with the smallest hash of id and text, at most ``LANDMARKS`` and
``TRAINING`` of them, landmarks of at most ``LANDMARK_BYTES`` each and ``ALL_LANDMARKS``
together.  The landmarks' n-grams are kept as posting lists (for each n-gram the
landmarks that hold it), so the model's size is that of those texts; it is checked
before it is broadcast.  Every row is scored where it lies, without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with
nothing to learn from, so is every text.  A text of any length is scored whole.  Of
languages with equal scores the first in order counts.  Repeated rows are scored each
for itself.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty, slices, smallest

LANDMARKS = 24
ALL_LANDMARKS = 240
LANDMARK_BYTES = 1 << 15
TRAINING = 400
# What a broadcast model may hold; a larger one is built again of fewer landmarks.
MODEL_BYTES = 256 << 20
# Postings that one product takes at a time.
PRODUCT = 4_000_000
LONGEST = 3
RIDGE = 1e-3
NO_LANGUAGE = "und"
GROUP = 256


def grams(text: str) -> np.ndarray:
    """Sorted distinct codes of the n-grams of the lower-cased letters and spaces."""
    plain = "".join(c if c.isalpha() else " " for c in text.lower())
    points = np.frombuffer(f" {' '.join(plain.split())} ".encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    codes, found = points, [points]
    for n in range(1, LONGEST):
        if len(points) <= n:
            break
        codes = (codes[:-1] << 21) | points[n:]
        found.append(codes)
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Space:
    """The landmarks' n-grams in order, which landmarks hold each, and how many each landmark holds."""

    codes: np.ndarray
    begins: np.ndarray  # where each n-gram's postings begin, and the end of the last
    postings: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, landmarks: list[np.ndarray]) -> Space:
        flat = np.concatenate(landmarks)
        owner = np.repeat(np.arange(len(landmarks), dtype=np.int32), [len(x) for x in landmarks])
        order = np.argsort(flat, kind="stable")
        codes, begins = np.unique(flat[order], return_index=True)
        return cls(codes, np.append(begins, len(flat)), owner[order], np.array([len(x) for x in landmarks], dtype=np.float64))

    @property
    def size_bytes(self) -> int:
        return sum(x.nbytes for x in (self.codes, self.begins, self.postings, self.sizes))

    def shared(self, texts: list[np.ndarray]) -> np.ndarray:
        """How many n-grams each text (rows) shares with each landmark (columns): the product of
        the two sparse presence matrices, so many postings at a time."""
        width = len(self.sizes)
        out = np.zeros(len(texts) * width)
        waiting, total = [], 0

        def multiply() -> None:
            at, rows = np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])
            first, many = self.begins[at], self.begins[at + 1] - self.begins[at]
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            columns = self.postings[np.repeat(first, many) + step]
            np.add(out, np.bincount(np.repeat(rows, many) * width + columns, minlength=len(out)), out=out)

        for i, own in enumerate(texts):
            # A long text's n-grams are taken in parts.
            for part in np.array_split(own, max(1, len(own) * width // PRODUCT)):
                at = np.searchsorted(self.codes, part)
                at[at == len(self.codes)] = 0
                at = at[self.codes[at] == part]
                postings = int((self.begins[at + 1] - self.begins[at]).sum())
                if waiting and total + postings > PRODUCT:
                    multiply()
                    waiting, total = [], 0
                waiting.append((at, np.full(len(at), i)))
                total += postings
        if waiting:
            multiply()
        return out.reshape(len(texts), width)

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts (rows) and landmarks (columns)."""
        sizes = np.array([max(len(x), 1) for x in texts], dtype=np.float64)
        return self.shared(texts) / np.sqrt(np.outer(sizes, self.sizes))


@dataclass(frozen=True)
class Model:
    space: Space
    weights: np.ndarray  # landmarks x languages, Nyström map and regression in one
    offsets: np.ndarray
    languages: list[str]

    def predict(self, texts: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
        scores = self.space.kernel(texts) @ self.weights + self.offsets
        best = scores.argmax(axis=1)
        chances = np.exp(8 * (scores - scores.max(axis=1, keepdims=True)))
        return [self.languages[b] for b in best], chances.max(axis=1) / chances.sum(axis=1)


def _sample_hashes(rows: DataFrame, per_language: int) -> dict[str, list[int]]:
    """Per language the smallest different hashes of its rows, at most ``per_language``, in order."""
    hashes = rows.select("lang", "h").distinct()
    found: dict[str, list[int]] = {}
    for r in smallest(hashes, "lang", [F.col("h")], per_language).orderBy("lang", "h").collect():
        found.setdefault(r.lang, []).append(r.h)
    return found


def _up_to(rows: DataFrame, hashes: dict[str, list[int]], count: int) -> DataFrame:
    """The rows of the first ``count`` hashes of each language; a repeated row once.  No text is shuffled but theirs."""
    last = F.create_map(*[F.lit(x) for lang, own in hashes.items() for x in (lang, own[:count][-1])])
    return rows.where(F.col("h") <= F.element_at(last, F.col("lang"))).dropDuplicates(["lang", "h"])


def _with_grams(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            codes = pa.array([grams(t) for t in part.column("text").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("lang"), codes], ["lang", "codes"])

    return df.select("lang", "text").mapInArrow(run, "lang string, codes array<bigint>")


def fit(labelled: DataFrame, landmarks: int = LANDMARKS, training: int = TRAINING) -> Model | None:
    """A model learned from ``doc_id``, ``text``, ``lang`` rows, or None if there are none.

    Of the sample, only landmark n-grams and kernel rows reach the driver.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("text", "lang", F.xxhash64("doc_id", "text").alias("h"))
    hashes = _sample_hashes(rows, training)
    if not hashes:
        return None
    short = rows.where(F.octet_length("text") <= LANDMARK_BYTES)
    # Where every text is longer, the longer ones serve as landmarks, and the check decides.
    marks, among = _sample_hashes(short, landmarks), short
    if not marks:
        marks, among = _sample_hashes(rows, landmarks), rows
    each = max(1, min(landmarks, ALL_LANDMARKS // len(marks)))
    while True:
        codes = [np.array(r.codes, dtype=np.int64) for r in _with_grams(_up_to(among, marks, each)).collect()]
        space = Space.of(codes)
        if space.size_bytes <= MODEL_BYTES:
            break
        if each == 1:
            raise ValueError(f"landmarks of {space.size_bytes} bytes are too large to broadcast")
        each //= 2
    shared = labelled.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [c.values.to_numpy() for c in batch.column("codes")]
            for at in range(0, len(texts), GROUP):
                values = shared.value.kernel(texts[at : at + GROUP])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(at, GROUP), pa.array(list(values), pa.list_(pa.float64()))], ["lang", "k"]
                )

    sample = _with_grams(_up_to(rows, hashes, training)).mapInArrow(run, "lang string, k array<double>").collect()
    names = sorted({r.lang for r in sample})
    kernel = np.array([r.k for r in sample])
    mutual = space.kernel(codes)
    values, vectors = np.linalg.eigh(mutual.astype(np.float64))
    sound = values > 1e-6 * values.max()
    mapping = vectors[:, sound] / np.sqrt(values[sound])
    inner = kernel @ mapping
    center = inner.mean(axis=0)
    sides = np.array([[1.0 if r.lang == n else -1.0 for n in names] for r in sample])
    level = sides.mean(axis=0)
    left = (inner - center).T @ (inner - center) + RIDGE * len(sample) * np.eye(inner.shape[1])
    ridge = np.linalg.solve(left, (inner - center).T @ (sides - level))
    return Model(space, mapping @ ridge, level - center @ ridge, names)


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1) of every row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            languages, scores = [NO_LANGUAGE] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if learned and any(map(str.isalpha, t))]
            for at in range(0, len(known), GROUP):
                own = known[at : at + GROUP]
                names, chances = learned.predict([grams(texts[i]) for i in own])
                for i, name, chance in zip(own, names, chances):
                    languages[i], scores[i] = name, float(chance)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def held_out(doc_id: Column, modulus: int) -> Column:
    """Whether the checksum of the id leaves the remainder 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 2, F.lit(False))
