"""Quality by weak supervision: rules vote or abstain, EM weighs them.

``features`` counts what the rules look at, ``RULES`` turn the counts into votes
(1 good, -1 bad, 0 abstain), ``fit`` estimates by expectation-maximisation how
often each rule votes which way on good and on bad documents, and ``quality`` is the
posterior probability of a good document.  EM starts from the majority of the
votes, so that a rule is first judged by how it goes with the others, and takes
abstaining for the third outcome of a rule.  Everything is a column expression;
EM runs on the counts of vote patterns, of which there are at most 3 to the
number of rules, and only its parameters are seen by the driver.

Rules of words and sentences know every script: words may have combining marks,
and sentences end with the marks of any script.  Scripts that put no spaces
between words have no words to count, so on a text of them the rules that count
words abstain.  A document that passes the base tests goes only if some rule
votes against it.

A null text has no words.  A text with fewer than three words has no windows.
Repeated rows count each for itself.  On an empty table the expected parameters
(START) remain.  Other columns are passed through by ``judge`` and ignored by ``features``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import numbered, or_empty, stage

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
# Marks that end a sentence before white space (Unicode's Sentence_Terminal), beyond ASCII, and those that need none after
# them.  Classes test the range first, so that a letter of a common script passes one comparison and not all marks.
ENDS = (
    r"։؝-؟۔܀-܂߹࠷࠹࠽࠾।॥၊။።፧፨᙮"
    r"᜵᜶។៕᠃᠉᥄᥅᪨-᪫᭚᭛᭞᭟᰻᰼᱾᱿‼‽⁇-⁉"
    r"…⸮⸼꓿꘎꘏꛳꛷꡶꡷꣎꣏꤯꧈꧉꩝-꩟꫰꫱꯫﹒﹖﹗"
)
WIDE_ENDS = r"。！．？｡"


def _beyond(ascii_signs: str, others: str) -> str:
    """A class of ASCII signs, and of others from U+00A0 on."""
    return rf"[{ascii_signs}[ -￿&&[{others}]]]"


CLOSING = _beyond(r"\"')\]}", r"\p{Pe}\p{Pf}")
END = rf"(?:[.?!]|[։-﹗&&[{ENDS}]]){CLOSING}*+(?=[\x20\x09-\x0D]|$)|[。-｡&&[{WIDE_ENDS}]]"
# A word of letters, with the punctuation of prose around it at most.  Inside: marks, joiners, apostrophes and hyphens.
PROSE = (
    r"(?<![^\x20\x09-\x0D])" + _beyond(r"\"'(\[{", r"\p{Ps}\p{Pi}¡¿") + r"?\p{L}"
    + _beyond(r"\p{L}'-", r"\p{M}’·׳״‌‍\p{Pd}") + "*+"
    + _beyond(r".,;:?!)\]}\"'", rf"{ENDS}{WIDE_ENDS}՝،؛፣-፦\p{{Pe}}\p{{Pf}}") + r"{0,2}(?![^\x20\x09-\x0D])"
)
# Letters of the scripts without spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer, Tai, Balinese, Javanese, kana, Han.
UNSPACED = (
    r"[฀-\x{3FFFF}&&[฀-࿿က-႟ក-៿ᥐ-᧿ᨠ-᪯ᬀ-᭿぀-ヿㇰ-ㇿ"
    r"㐀-䶿一-鿿ꦀ-꧿ꩠ-꫟豈-﫿ｦ-ﾝ\x{20000}-\x{3FFFF}]]"
)

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_distinct_words", "n_ends", "n_prose", "n_bangs",
    "n_unspaced",
]

# The names of ``rules``.
RULES = ["length", "symbols", "upper", "dup_lines", "repeats", "word_length", "variety", "sentences", "prose", "bangs"]


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_counts`` of COUNTS.

    Windows are compared by 64-bit hashes.  Sorting them is needed only where
    some window occurs twice, which a set of the hashes tells.
    """
    body = or_empty(text)
    words = docs.withColumn("_words", F.array_remove(F.split(body, SPACE), ""))
    lines = words.withColumn("_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_SPACE)))
    windows = lines.withColumn(
        "_windows",
        F.when(
            F.size("_words") >= 3,
            F.transform(
                F.slice("_words", 1, F.size("_words") - 2),
                lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    ordered = windows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    repeated = F.filter(
        "_sorted",
        lambda x, i: F.coalesce(F.get("_sorted", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_sorted", i + 1)["h"] == x["h"], F.lit(False)),
    )
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    long = lambda c: c.cast("bigint")
    return ordered.withColumn(
        "_counts",
        F.struct(
            long(F.size("_words")).alias("n_words"),
            long(F.length(F.array_join("_words", ""))).alias("word_chars"),
            long(F.regexp_count(body, F.lit(SYMBOLS))).alias("n_symbols"),
            long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
            long(F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(covered))).alias("n_repeat_words"),
            long(F.size("_lines")).alias("n_lines"),
            long(F.regexp_count(body, F.lit(r"\p{Lu}"))).alias("n_upper"),
            long(F.size(F.array_distinct("_words"))).alias("n_distinct_words"),
            long(F.regexp_count(body, F.lit(END))).alias("n_ends"),
            long(F.regexp_count(body, F.lit(PROSE))).alias("n_prose"),
            long(F.regexp_count(body, F.lit("!!"))).alias("n_bangs"),
            # A text of ASCII has none.
            long(F.when(F.octet_length(body) == F.length(body), 0).otherwise(F.regexp_count(body, F.lit(UNSPACED)))).alias("n_unspaced"),
        ),
    ).drop("_words", "_lines", "_windows", "_sorted")


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and COUNTS of every row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return with_counts(rows).select("doc_id", "_counts.*")


def _three(good: Column | None, bad: Column) -> Column:
    """Good and bad conditions; neither, or an undefined one, abstains."""
    vote = F.when(bad, -1)
    return (vote if good is None else vote.when(good, 1)).otherwise(0)


def rules(c) -> dict[str, Column]:
    """The votes; ``c`` gives a count's column by name.

    Most rules know one sort of rubbish and abstain otherwise; two also know prose.
    """
    words = F.greatest(c("n_words"), F.lit(1))
    per_word = lambda name: c(name) / words
    spread = c("n_distinct_words") / F.sqrt(words)
    mean = c("word_chars") / words
    spaced = c("n_unspaced") <= 0.3 * c("word_chars")
    many = spaced & (c("n_words") >= 20)
    return {
        "length": _three(None, spaced & (c("n_words") < 30)),
        "symbols": _three(None, per_word("n_symbols") > 0.2),
        "upper": _three(None, c("n_upper") > 0.5 * c("word_chars")),
        "dup_lines": _three(None, c("n_dup_lines") > 0.4 * c("n_lines")),
        "repeats": _three(None, per_word("n_repeat_words") > 0.4),
        "word_length": _three(None, spaced & ((mean < 2) | (mean > 20))),
        "variety": _three(None, many & (spread < 1.5)),
        "sentences": _three(many & (per_word("n_ends") > 0.01) & (per_word("n_ends") < 0.4), many & (c("n_ends") == 0)),
        "prose": _three(many & (per_word("n_prose") > 0.85), many & (per_word("n_prose") < 0.6)),
        "bangs": _three(None, many & (per_word("n_bangs") > 0.3)),
    }


@dataclass(frozen=True)
class Model:
    """Share of good documents; per rule the chances of a good and a bad vote on either kind."""

    prior: float
    on_good: dict[str, tuple[float, float]]
    on_bad: dict[str, tuple[float, float]]


_PROSE = ("sentences", "prose")
START = Model(
    0.8,
    {n: (0.8, 0.02) if n in _PROSE else (0.0, 0.02) for n in RULES},
    {n: (0.3, 0.4) if n in _PROSE else (0.0, 0.4) for n in RULES},
)
# The expected chances weigh as much as this share of all documents in either kind.
SHARE = 0.1
# The chance of a good document that EM starts from where the votes for it, or against it, are more.
MAJORITY = 0.99


def _chances(pair: tuple[float, float]) -> dict[int, float]:
    good, bad = pair
    return {vote: max(p, 1e-3) for vote, p in ((1, good), (-1, bad), (0, 1 - good - bad))}


def posterior(model: Model, votes) -> Column:
    """Probability of a good document; ``votes`` gives a rule's vote column by name."""
    terms = [F.lit(log(model.prior / (1 - model.prior)))]
    for name in RULES:
        on_good, on_bad = _chances(model.on_good[name]), _chances(model.on_bad[name])
        ratio = {v: log(on_good[v] / on_bad[v]) for v in (1, -1, 0)}
        terms.append(F.when(votes(name) > 0, ratio[1]).when(votes(name) < 0, ratio[-1]).otherwise(ratio[0]))
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms)))


def majority(votes) -> Column:
    """Probability of a good document by the number of votes alone."""
    total = reduce(lambda a, b: a + b, [votes(name).cast("int") for name in RULES])
    return F.when(total > 0, MAJORITY).when(total < 0, 1 - MAJORITY).otherwise(START.prior)


def fit(counts: DataFrame, rounds: int = 30, tolerance: float = 1e-3) -> Model:
    """Parameters estimated from the votes on all rows of ``counts``."""
    votes = counts.select(*[v.cast("tinyint").alias(n) for n, v in rules(F.col).items()])
    patterns = stage(votes.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")), "votes").coalesce(1)
    model, quality = START, majority(F.col)
    for _ in range(rounds):
        good = F.col("n") * quality
        weights = {"good": good, "bad": F.col("n") - good}
        sums = (
            patterns.agg(
                *[F.coalesce(F.sum(w), F.lit(0.0)).alias(kind) for kind, w in weights.items()],
                *[
                    F.coalesce(F.sum(F.when(F.col(name) == vote, w)), F.lit(0.0)).alias(f"{kind}_{name}_{vote}")
                    for kind, w in weights.items()
                    for name in RULES
                    for vote in (1, -1)
                ],
            )
            .first()
            .asDict()
        )
        rows = sums["good"] + sums["bad"]
        if not rows:
            return model

        def chances(kind: str, name: str, start: tuple[float, float]) -> tuple[float, float]:
            weight = rows * SHARE
            return tuple((sums[f"{kind}_{name}_{v}"] + weight * p) / (sums[kind] + weight) for v, p in zip((1, -1), start))

        new = Model(
            min(max(sums["good"] / rows, 0.01), 0.99),
            {n: chances("good", n, START.on_good[n]) for n in RULES},
            {n: chances("bad", n, START.on_bad[n]) for n in RULES},
        )
        pairs = [(new.on_good, model.on_good), (new.on_bad, model.on_bad)]
        moved = max(abs(x - y) for a, b in pairs for n in RULES for x, y in zip(a[n], b[n]))
        model, quality = new, posterior(new, F.col)
        if moved < tolerance:
            break
    return model


def base_failed(c) -> Column:
    return (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def verdict(model: Model, c, threshold: float = 0.5) -> tuple[Column, Column]:
    """Posterior and decision; ``c`` gives a count's column by name.

    Where no rule votes against a document, too few good votes are no reason to drop it.
    """
    votes = rules(c)
    quality = posterior(model, votes.__getitem__)
    unopposed = reduce(lambda a, b: a & b, [votes[name] >= 0 for name in RULES])
    return quality, ~base_failed(c) & (unopposed | (quality >= threshold))


def judge(counts: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``counts`` with ``base_failed``, ``kept`` and ``quality``.

    Give stored counts: a filter on ``kept`` would repeat the expressions of those yet to be worked out.
    """
    quality, kept = verdict(model, F.col, threshold)
    return counts.select("*", base_failed(F.col).alias("base_failed"), kept.alias("kept"), quality.alias("quality"))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, that the rules keep.

    The counts are worked out twice, for the fit and for the decision: that
    takes no shuffle and writes no text.
    """
    model = fit(stage(features(docs, docs.columns[0], text), "counts"))
    # The counts pass a generator, else the filter would be pushed below them with every count written out.
    rows, (own_text,) = numbered(docs, text)
    counted = with_counts(rows, own_text).withColumn("_once", F.explode(F.array("_counts")))
    _, kept = verdict(model, lambda name: F.col(f"_once.{name}"), threshold)
    return counted.where(kept).select(*rows.columns).toDF(*docs.columns)
