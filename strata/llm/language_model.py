"""Language-model scoring with a weighted backoff automaton.

The model is an n-gram model of characters with absolute discounting: contexts of
up to ``ORDER - 1`` characters are states, characters seen after them are arcs,
and every state has a failure arc to its longest shorter context whose weight is
the mass set aside for what was not seen.  A text is scored in one pass from
left to right: follow the arc of the next character, or fail to a shorter
context until there is one, and add up the logarithms.

Counts come from all training texts and grow with them, so neither the counts
nor the automaton are ever held in one place.  Texts are dealt into blocks of
bounded size.  A block asks for the words and n-grams that occur in it, together
with its own counts of them; sums over all blocks answer; and each block then
builds the part of the automaton that its texts can reach, which scores them as
the whole automaton would.

A null text is read as empty: it has the end only.  Repeated rows count and are
scored each for itself.  Without training texts all characters have one chance.
Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from math import ceil, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import or_empty, stage

ORDER = 4
DISCOUNT = 0.75
BLOCK_CHARS = 8_000_000
# Signs outside of Unicode for the start and the end of a text.
START, END = 0x110000, 0x110001
UNSEEN = 1 / 0x110001  # every character and the end, when nothing is known
LANE = 256
DENSE = 16_000_000

GRAM, WORD = b"g", b"w"


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lower-cased; bytes split at the six ASCII spaces."""
    return text.encode("utf-8").lower().split()


def points_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each behind its starts and before its end; and where each text begins."""
    parts, begins, at = [], [], 0
    start, end = np.full(ORDER - 1, START, np.uint32), np.array([END], np.uint32)
    for text in texts:
        own = np.frombuffer(text.encode("utf-8").lower().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        parts += [start, own, end]
        begins.append(at)
        at += len(own) + ORDER
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), np.array(begins, dtype=np.int64)


def _letters(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct characters in order, and each character's number among them."""
    number = np.zeros(END + 1, dtype=np.int32)
    number[points] = 1
    letters = np.flatnonzero(number).astype(np.uint32)
    number[letters] = np.arange(len(letters), dtype=np.int32)
    return letters, number[points]


def _gram_counts(points: np.ndarray, trained: np.ndarray) -> dict[bytes, int]:
    """Every n-gram of 1 to ORDER characters that ends in a text, with its count where ``trained``."""
    letters, ids = _letters(points)
    size = len(letters)
    ends = points[ORDER - 1 :] != START
    trained = trained[ORDER - 1 :][ends]
    if size**ORDER < 2**62:
        # The characters as one number, and below it whether the place counts.
        codes = np.zeros(len(points) - (ORDER - 1), dtype=np.int64)
        for k in range(ORDER):
            codes *= size
            codes += ids[k : len(ids) - (ORDER - 1 - k)]
        codes = codes[ends]
        codes <<= 1
        codes |= trained
        codes.sort()
        first = np.flatnonzero(np.concatenate([[True], codes[1:] >> 1 != codes[:-1] >> 1]))
        counts = np.add.reduceat(codes & 1, first)
        distinct = codes[first] >> 1
        columns = [distinct // size ** (ORDER - 1 - k) % size for k in range(ORDER)]
        rows = letters[np.stack(columns, axis=1)]
    else:
        windows = np.lib.stride_tricks.sliding_window_view(points, ORDER)[ends]
        rows, inverse = np.unique(windows, axis=0, return_inverse=True)
        counts = np.bincount(inverse.ravel(), weights=trained, minlength=len(rows)).astype(np.int64)
    found: dict[bytes, int] = {}
    for k in range(ORDER):
        # The last characters of the distinct n-grams, summed up.
        part = np.ascontiguousarray(rows[:, k:])
        names = part.view(np.dtype((np.void, 4 * (ORDER - k)))).ravel()
        shorter, inverse = np.unique(names, return_inverse=True)
        sums = np.bincount(inverse.ravel(), weights=counts, minlength=len(shorter)).astype(np.int64)
        found.update(zip([x.tobytes() for x in shorter], sums.tolist()))
    return found


def _requests(group: pa.Table) -> pa.Table:
    """What a block asks for: ``block``, ``key``, ``n`` (its own count in training texts)."""
    texts, held = group.column("text").to_pylist(), group.column("held_out").to_pylist()
    words: Counter[bytes] = Counter({b"": sum(not h for h in held)})
    for text, out in zip(texts, held):
        own = words_of(text)
        if out:
            for w in own:
                if w not in words:
                    words[w] = 0
        else:
            words.update(own)
    points, begins = points_of(texts)
    trained = np.repeat(~np.array(held, dtype=bool), np.diff(np.append(begins, len(points))))
    grams = _gram_counts(points, trained)
    start = np.full(ORDER - 1, START, np.uint32).tobytes()
    for k in range(ORDER):
        grams.setdefault(start[4 * k :], 0)
    keys = [WORD + w for w in words] + [GRAM + g for g in grams]
    counts = [*words.values(), *grams.values()]
    block = group.column("block")[0].as_py()
    return pa.table({"block": pa.array([block] * len(keys), pa.int32()), "key": pa.array(keys, pa.binary()), "n": pa.array(counts, pa.int64())})


class Automaton:
    """The part of the model that the texts of one block can reach."""

    def __init__(self, grams: list[tuple[bytes, int, int | None, int | None]]):
        """``grams``: (characters, count, count as a context, different characters after it)."""
        grams = sorted(grams, key=lambda g: len(g[0]))
        contexts = [(g, total, types) for g, _, total, types in grams if total and len(g) < 4 * ORDER]
        self.states = {g: i for i, (g, _, _) in enumerate(contexts)} or {b"": 0}
        size = len(self.states)
        self.root = self.states[b""]
        self.fail = np.full(size, self.root, dtype=np.int64)
        self.backoff = np.ones(size)
        totals = np.ones(size)
        for g, total, types in contexts:
            s = self.states[g]
            totals[s] = total
            self.backoff[s] = DISCOUNT * types / total
            if g:
                self.fail[s] = self.states[g[4:]]
        self.log_backoff = np.log10(self.backoff)
        letters = sorted({g[-4:] for g, count, _, _ in grams if g and count}, key=lambda x: int.from_bytes(x, "little"))
        self.letters = {x: i for i, x in enumerate(letters)}
        self.points = np.array([np.frombuffer(x, np.uint32)[0] for x in letters], dtype=np.uint32)
        self.width = max(len(letters), 1)
        chance: dict[bytes, float] = {}
        arcs, to, weight = [], [], []
        for g, count, _, _ in grams:
            if not (g and count):
                continue
            s = self.states[g[:-4]]
            shorter = chance[g[4:]] if len(g) > 4 else UNSEEN
            p = chance[g] = (count - DISCOUNT) / totals[s] + self.backoff[s] * shorter
            after = g if len(g) < 4 * ORDER else g[4:]
            while after not in self.states:
                after = after[4:]
            arcs.append(s * self.width + self.letters[g[-4:]])
            to.append(self.states[after])
            weight.append(log10(p))
        order = np.argsort(np.array(arcs, dtype=np.int64))
        self.arcs = np.array(arcs, dtype=np.int64)[order]
        self.to = np.array(to, dtype=np.int64)[order]
        self.weight = np.array(weight)[order]
        self.table = None
        if size * self.width <= DENSE:
            self.table = np.full(size * self.width, -1, dtype=np.int32)
            self.table[self.arcs] = np.arange(len(self.arcs), dtype=np.int32)
        start = np.full(ORDER - 1, START, np.uint32).tobytes()
        while start not in self.states:
            start = start[4:]
        self.start = self.states[start]

    def _arc(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Arc numbers, -1 where there is none."""
        at = state * self.width + letter
        if self.table is not None:
            found = self.table[at].astype(np.int64)
        else:
            place = np.minimum(np.searchsorted(self.arcs, at), len(self.arcs) - 1)
            found = np.where(self.arcs[place] == at, place, -1) if len(self.arcs) else np.full(len(at), -1)
        found[letter < 0] = -1
        return found

    def step(self, state: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and log probabilities of a letter each (-1: one never seen)."""
        arc = self._arc(state, letter)
        lost = np.zeros(len(state))
        open_ = np.flatnonzero(arc < 0)
        at = state[open_]
        while len(open_):
            lost[open_] += self.log_backoff[at]
            deeper = at != self.root
            open_, at = open_[deeper], self.fail[at[deeper]]
            arc[open_] = self._arc(at, letter[open_])
            missing = arc[open_] < 0
            open_, at = open_[missing], at[missing]
        known = arc >= 0
        if not len(self.to):
            return np.full(len(state), self.root), lost + log10(UNSEEN)
        return np.where(known, self.to[arc], self.root), lost + np.where(known, self.weight[arc], log10(UNSEEN))

    def score(self, points: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Log probability of each text.  Texts go side by side in lanes of LANE characters; a
        lane that begins inside a text first reads the characters its state depends on."""
        number = np.full(END + 1, -1, dtype=np.int32)
        number[self.points] = np.arange(len(self.points), dtype=np.int32)
        letter = number[points]
        ends = np.append(begins[1:], len(points))
        lanes = [np.arange(b + ORDER - 1, e, LANE) for b, e in zip(begins, ends)]
        text = np.repeat(np.arange(len(begins)), [len(x) for x in lanes])
        at = np.concatenate(lanes) if lanes else np.zeros(0, np.int64)
        last = np.minimum(at + LANE, ends[text])
        inside = at > begins[text] + ORDER - 1
        state = np.where(inside, self.root, self.start)
        for k in range(ORDER - 1, 0, -1):
            own = np.flatnonzero(inside)
            state[own], _ = self.step(state[own], letter[at[own] - k])
        total = np.zeros(len(at))
        for k in range(LANE):
            own = np.flatnonzero(at + k < last)
            if not len(own):
                break
            state[own], gained = self.step(state[own], letter[at[own] + k])
            total[own] += gained
        return np.bincount(text, weights=total, minlength=len(begins))


def _score(docs: pa.Table, answers: pa.Table, tokens: int, types: int) -> pa.Table:
    texts = docs.column("text").to_pylist()
    keys = answers.column("key").to_pylist()
    totals = answers.column("total").to_numpy()
    # 0 exactly for a word that is not known.
    logs = {k[1:]: x for k, x in zip(keys, np.log10(totals + 1).tolist()) if k[:1] == WORD}
    rest_of = (answers.column("context").to_pylist(), answers.column("types").to_pylist())
    grams = [(k[1:], n, c, t) for k, n, c, t in zip(keys, totals.tolist(), *rest_of) if k[:1] == GRAM]
    rest = log10(tokens + types + 1)
    counts, knowns, bases = [], [], []
    for text in texts:
        own = words_of(text)
        own.append(b"")
        each = [logs[w] for w in own]
        counts.append(len(own))
        knowns.append(len(own) - each.count(0.0))
        bases.append(sum(each) - len(own) * rest)
    automaton = Automaton(grams)
    points, begins = points_of(texts)
    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "n_tokens": pa.array(counts, pa.int64()),
            "n_known": pa.array(knowns, pa.int64()),
            "train_tokens": pa.array([tokens] * len(texts), pa.int64()),
            "base_score": pa.array(bases, pa.float64()),
            "score": pa.array(automaton.score(points, begins), pa.float64()),
        }
    )


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``, learned from the rows that are not ``held_out``.

    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (smoothed word counts) and ``score`` (the automaton's log10
    probability of the text).
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"), held_out.alias("held_out"))
    size = rows.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0))).first()[0]
    blocks = max(1, ceil(size / BLOCK_CHARS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    asked = stage(dealt.groupBy("block").applyInArrow(_requests, "block int, key binary, n bigint"), "asked")
    is_gram = F.substring("key", 1, 1) == F.lit(GRAM)
    every = Window.partitionBy("key")
    summed = asked.select(
        "block", "key", F.sum("n").over(every).alias("total"), (F.col("block") == F.min("block").over(every)).alias("once")
    )
    # A context's counts are sums over the different n-grams that extend it.
    grams = asked.where(is_gram & (F.length("key") > 1)).groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
    contexts = grams.groupBy(F.expr("substring(key, 1, length(key) - 4)").alias("key")).agg(
        F.sum("n").alias("context"), F.count(F.lit(1)).alias("types")
    )
    answers = stage(summed.join(contexts, "key", "left"), "answers")
    first = answers.where("once and total > 0").where(~is_gram)
    tokens, types = first.agg(F.coalesce(F.sum("total"), F.lit(0)), F.count(F.lit(1))).first()
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        return _score(own, found, tokens, types)

    return (
        dealt.groupBy("block")
        .cogroup(answers.drop("once").groupBy("block"))
        .applyInArrow(
            run,
            f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        )
    )
