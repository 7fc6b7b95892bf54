"""Personal data: fixed base patterns, and identifiers found by their contexts.

Base spans (e-mail, IP, card, phone) are the seeds.  The words around a seed make
lexical patterns; the same is done for every other token with digits, and for
tokens with digits that stand in a row, as in "06 12 34 56 78".  Spark then scores
the graph of patterns and instances in rounds: a pattern is worth the mean trust
of the instances it occurs with, if enough of them are trusted; an instance the chance
that not all its patterns are wrong.  What a round comes to trust supports patterns
in the next, until nothing is gained.  Trusted identifiers are reported with the
kind of the seeds: those with ``ANYWHERE`` digits wherever they stand, shorter ones
(which may as well be a year or a number of things) in a trusted pattern's slot.

The graph is a table of distinct (pattern, instance) pairs; each round is two
joins and two aggregates on it, so no pattern's instances meet in one task but as
sums.  Texts are read once, where they lie.

Defined cases: a null text is empty.  Repeated rows are scanned each for itself but are
one instance in the graph.  Of ties between kinds the first in the alphabet counts; of
spans inside one another the longer stays.  Texts of any length are scanned whole, in
linear time.  Other columns, whatever their names, are ignored, or passed through
by ``redact``.  Without seeds there are no patterns and only base spans; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import numbered, or_empty, slices, stage

KINDS = ["email", "ip", "card", "phone"]
# Rounds at most; they end when nothing is gained.
ROUNDS = 8
# Trusted instances a pattern needs, least worth of a pattern, least trust of a finding.
SEEDS, WORTH, TRUSTED = 3, 0.6, 0.8
# Digits of a candidate, and of an identifier that counts wherever it stands.
DIGITS, ANYWHERE = 3, 6
# Tokens in a row are also taken together if they are no longer than this.
JOINED_CHARS = 40
CONTEXT_CHARS = 80

# The base patterns.  A run of digits is entered only at its start,
# and e-mails are read outwards from their @, so that long runs take linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Tokens with a digit, joined by single spaces; entered only where a token begins.
NUMBERED = re.compile(r"(?<!\S)[^\s0-9]*+[0-9]\S*+(?: [^\s0-9]*+[0-9]\S*+)*+")
# Signs that are no part of a token they stand beside, and those that end a row of tokens.
EDGE = ",;:!?.\"'[]{}<>|*#$%&="
STOPS = ",;:!?."


def emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL_END.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            done = domain.end()
        # A local part holds no @, so a start before this one is of no later use.
        done = max(done, at + 1)
        at = text.find("@", done)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    found = [("email", s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without the signs at its edges; a bracket stays where its partner is inside."""
    while start < end and (text[start] in EDGE or text[start] in "()" and (text[start] == ")" or ")" not in text[start:end])):
        start += 1
    while end > start and (text[end - 1] in EDGE or text[end - 1] in "()" and (text[end - 1] == "(" or "(" not in text[start:end])):
        end -= 1
    return start, end


def other_tokens(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Tokens with digits, alone and in a row, that touch no base span."""
    found = []
    for m in NUMBERED.finditer(text):
        row, at = [], m.start()
        for token in m[0].split(" "):
            end = at + len(token)
            # A base span, or the end of a clause, parts a row.
            if any(s < end and at < e for _, s, e in base):
                found += _of_row(text, row)
                row = []
            else:
                row.append((at, end))
                if token[-1] in STOPS:
                    found += _of_row(text, row)
                    row = []
            at = end + 1
        found += _of_row(text, row)
    return found


def _of_row(text: str, row: list[tuple[int, int]]) -> list[tuple[int, int]]:
    spans = [trimmed(text, *t) for t in row]
    if len(row) > 1 and row[-1][1] - row[0][0] <= JOINED_CHARS:
        spans.append(trimmed(text, row[0][0], row[-1][1]))
    return [(s, e) for s, e in spans if len(digits_of(text[s:e])) >= DIGITS]


def patterns_of(text: str, start: int, end: int) -> list[str]:
    """The two words before; the word before with the word after."""
    before = text[max(0, start - CONTEXT_CHARS) : start].lower().split()[-2:]
    after = text[end : end + CONTEXT_CHARS].lower().split()[:1]
    if start and before and not text[start - 1].isspace() and len(before[-1]) > 20:
        return []
    return [f"before {' '.join(before)}", f"around {' '.join(before[-1:])} _ {' '.join(after)}"]


_OCCURRENCE = "array<struct<kind:string,start:bigint,end:bigint,instance:string,patterns:array<string>>>"


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row``, ``doc_id``, ``digest`` of the text and ``found``: seeds (with kind) and other tokens (without).

    Written to the shared folder, so that ``row`` names a row for good.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), or_empty(text).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    item = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = []
            for t in part.column("text").to_pylist():
                base = base_spans(t)
                spans = [*base, *[(None, s, e) for s, e in other_tokens(t, base)]]
                found.append(
                    [
                        {"kind": k, "start": s, "end": e, "instance": t[s:e].lower(), "patterns": patterns_of(t, s, e)}
                        for k, s, e in spans
                    ]
                )
            columns = [part.column("doc_id"), part.column("digest"), pa.array(found, pa.list_(item))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "found"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    scanned = rows.mapInArrow(run, f"doc_id {id_type}, digest binary, found {_OCCURRENCE}")
    return stage(scanned.select(F.monotonically_increasing_id().alias("row"), "*"), "occurrences")


def bootstrap(found: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Trusted unseen identifiers (``instance``, ``kind``) and trusted patterns (``pattern``, ``kind``).

    ``found`` is the result of ``occurrences``.
    """
    each = found.select(F.explode("found").alias("o")).select("o.kind", "o.instance", F.explode("o.patterns").alias("pattern"))
    # A kind's instances are its own; a string that is a seed anywhere is no candidate.
    edges = stage(each.groupBy("pattern", "instance").agg(F.min("kind").alias("kind")), "edges")
    seeds = edges.where("kind is not null").groupBy("instance", "kind").agg(F.lit(1.0).alias("trust"))
    seeds = stage(seeds, "seeds")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    graph = stage(edges.select("pattern", "instance").join(sizes, "pattern"), "graph")
    unseen = stage(graph.join(seeds, "instance", "left_anti").select("instance", "pattern"), "unseen")
    trust, known = seeds, -1
    for _ in range(rounds):
        worth = (
            graph.join(trust, "instance")
            .groupBy("pattern", "kind")
            .agg((F.sum("trust") / F.first("size")).alias("worth"), F.count_if(F.col("trust") >= TRUSTED).alias("sure"))
            .where((F.col("worth") >= WORTH) & (F.col("sure") >= SEEDS))
        )
        worth = stage(worth.select("pattern", "kind", "worth"), "worth")
        gained = (
            unseen.join(worth, "pattern")
            .groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("worth", F.lit(0.999)))))).alias("trust"))
        )
        gained = stage(gained, "gained")
        trust = seeds.unionByName(gained)
        sure = gained.where(F.col("trust") >= TRUSTED).count()
        if sure <= known:
            break
        known = sure
    return gained.where(F.col("trust") >= TRUSTED).select("instance", "kind"), worth.select("pattern", "kind")


def found_spans(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``found`` with ``extra``: the spans (kind, start, end) of unseen identifiers in each row."""
    sure, patterns = bootstrap(found, rounds)
    long = F.length(F.regexp_replace("instance", "[^0-9]", "")) >= ANYWHERE
    tokens = found.select("row", F.explode("found").alias("o")).where("o.kind is null").select("row", "o.*").drop("kind")
    tokens = tokens.join(sure, "instance")
    slots = tokens.where(~long).withColumn("pattern", F.explode("patterns")).join(patterns, ["pattern", "kind"])
    spans = tokens.where(long).select("row", "start", "end", "kind").unionByName(slots.select("row", "start", "end", "kind"))
    spans = spans.groupBy("row", "start", "end").agg(F.min("kind").alias("kind"))
    # Sorted so that a span comes after those it may lie in.
    before = Window.partitionBy("row").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reached", F.max("end").over(before))
    spans = spans.where(F.col("reached").isNull() | (F.col("end") > F.col("reached")))
    spans = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("extra"))
    return found.join(spans, "row", "left")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by ``[KIND]``, and ``n_chars`` (if there) set anew.

    Overlapping spans become one, named after the first.  A null text stays null.
    """
    spans = found_spans(occurrences(docs, doc_id, text)).where("extra is not null")
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("extra").alias("_extra"))
    spans = spans.dropDuplicates(["_id", "_digest"])
    rows, (own_id, own_text, own_chars) = numbered(docs, doc_id, text, n_chars)
    own = F.unhex(F.md5(or_empty(own_text)))
    same = F.col(own_id).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest"))
    joined = rows.withColumn("_own", own).join(spans, same, "left").drop("_own", "_id", "_digest")
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, own_text):
            texts = []
            for t, extra in zip(part.column(own_text).to_pylist(), part.column("_extra").to_pylist()):
                if not t:
                    texts.append(t)
                    continue
                more = [(x["kind"], x["start"], x["end"]) for x in extra or []]
                out, done = [], 0
                for kind, start, end in sorted([*base_spans(t), *more], key=lambda s: (s[1], -s[2])):
                    if start >= done:
                        out += [t[done:start], f"[{kind.upper()}]"]
                    done = max(done, end)
                texts.append("".join([*out, t[done:]]))
            columns = []
            for name in schema.names:
                column = part.column(name)
                if name == own_text:
                    column = pa.array(texts, column.type)
                elif name == own_chars:
                    column = pa.array([None if t is None else len(t) for t in texts], column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema).toDF(*docs.columns)
