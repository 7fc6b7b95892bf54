"""License scans by ordered signature rules, in column expressions.

A row whose lower-cased text holds none of the gate words is settled at once.
Otherwise each rule whose keyword the text holds runs its pattern over the whole
text; its matches become intervals.  Gate words and keywords are looked up in a
copy with each run of white space folded to one space, as the patterns allow any
white space between words: a name broken over a line activates its rule.  Longer intervals win over those inside
them, and among equal ones the rule with the higher priority wins.

Base phrases (fixed by the contract of the query) are found over words, which
are runs of digits, lower-case ASCII letters and non-ASCII characters.

A null text is read as empty: no words, no labels, score 0.  Repeated rows are
scanned each for itself; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import or_empty

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases of the base labels.
PHRASES = {
    "gpl": ["gnu", "general", "public", "license"],
    "apache": ["apache", "license"],
    "cc-by": ["cc", "by"],
    "mit": ["mit", "license"],
}

# License families as (label, written names, SPDX stems, versions).
FAMILIES = [
    ("agpl", ["gnu affero general public license", "affero general public license", "agpl"], ["agpl"], ["1.0", "3.0"]),
    ("lgpl", ["gnu lesser general public license", "gnu library general public license", "lgpl"], ["lgpl"], ["2.0", "2.1", "3.0"]),
    ("gpl", ["gnu general public license", "gnu gpl", "gpl"], ["gpl"], ["1.0", "2.0", "3.0"]),
    ("gfdl", ["gnu free documentation license", "gfdl"], ["gfdl"], ["1.1", "1.2", "1.3"]),
    ("apache", ["apache license", "apache software license"], ["apache"], ["1.0", "1.1", "2.0"]),
    ("mit", ["mit license", "expat license", "x11 license"], ["mit"], []),
    ("bsd", ["bsd license", "berkeley software distribution license"], ["bsd"], []),
    ("bsd-2-clause", ["bsd 2-clause", "simplified bsd license", "freebsd license"], ["bsd-2-clause"], []),
    ("bsd-3-clause", ["bsd 3-clause", "new bsd license", "modified bsd license"], ["bsd-3-clause"], []),
    ("mpl", ["mozilla public license"], ["mpl"], ["1.0", "1.1", "2.0"]),
    ("epl", ["eclipse public license"], ["epl"], ["1.0", "2.0"]),
    ("cddl", ["common development and distribution license"], ["cddl"], ["1.0", "1.1"]),
    ("cpl", ["common public license"], ["cpl"], ["1.0"]),
    ("eupl", ["european union public licence", "european union public license"], ["eupl"], ["1.0", "1.1", "1.2"]),
    ("artistic", ["artistic license"], ["artistic"], ["1.0", "2.0"]),
    ("zlib", ["zlib license", "zlib/libpng license"], ["zlib"], []),
    ("isc", ["isc license"], ["isc"], []),
    ("bsl", ["boost software license"], ["bsl"], ["1.0"]),
    ("psf", ["python software foundation license", "psf license"], ["psf", "python"], ["2.0"]),
    ("ofl", ["sil open font license", "open font license"], ["ofl"], ["1.0", "1.1"]),
    ("unlicense", ["the unlicense", "unlicense"], ["unlicense"], []),
    ("wtfpl", ["do what the fuck you want to public license", "wtfpl"], ["wtfpl"], []),
    ("afl", ["academic free license"], ["afl"], ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("osl", ["open software license"], ["osl"], ["1.0", "2.0", "2.1", "3.0"]),
    ("ms-pl", ["microsoft public license"], ["ms-pl"], []),
    ("ms-rl", ["microsoft reciprocal license"], ["ms-rl"], []),
    ("php", ["php license"], ["php"], ["3.0", "3.01"]),
    ("ruby", ["ruby license"], ["ruby"], []),
    ("ncsa", ["university of illinois/ncsa open source license"], ["ncsa"], []),
    ("postgresql", ["postgresql license"], ["postgresql"], []),
    ("openssl", ["openssl license"], ["openssl"], []),
    ("odbl", ["open database license", "odbl"], ["odbl"], ["1.0"]),
    ("pddl", ["public domain dedication and license"], ["pddl"], ["1.0"]),
    ("upl", ["universal permissive license"], ["upl"], ["1.0"]),
    ("vim", ["vim license"], ["vim"], []),
    ("w3c", ["w3c software notice and license", "w3c license"], ["w3c"], []),
    ("zpl", ["zope public license"], ["zpl"], ["1.1", "2.0", "2.1"]),
    ("sspl", ["server side public license"], ["sspl"], ["1.0"]),
    ("busl", ["business source license"], ["busl"], ["1.1"]),
    ("cecill", ["cecill free software license", "cecill"], ["cecill"], ["1.0", "1.1", "2.0", "2.1"]),
    ("cc-by", ["creative commons attribution", "cc by", "cc-by"], ["cc-by"], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-sa", ["creative commons attribution-sharealike", "cc by-sa", "cc-by-sa"], ["cc-by-sa"], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc", ["creative commons attribution-noncommercial", "cc by-nc", "cc-by-nc"], ["cc-by-nc"], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nd", ["creative commons attribution-noderivatives", "cc by-nd", "cc-by-nd"], ["cc-by-nd"], ["1.0", "2.0", "2.5", "3.0", "4.0"]),
    ("cc0", ["creative commons zero", "cc0"], ["cc0"], ["1.0"]),
]

# Sentences that tell a license by its text (label, keyword, pattern).
SENTENCES = [
    ("mit", "free of charge", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "and/or distribute", r"permission to use, copy, modify, and/or distribute this software for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd-3-clause", "endorse or promote", r"neither the name of .{1,80}? may be used to endorse or promote products"),
    ("gpl", "free software foundation", r"under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "free software foundation", r"under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "free software foundation", r"under the terms of the gnu affero general public license as published by the free software foundation"),
    ("zlib", "as-is", r"this software is provided 'as-is', without any express or implied warranty"),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(released|dedicated|placed) (in|into|to) the public domain"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
]

_RULE = "array<struct<keyword:string,pattern:string,label:string,priority:int,weight:double>>"


def _spaced(name: str) -> str:
    """A name as a pattern: any white space between its words."""
    escaped = "".join(f"\\{c}" if c in r"\.^$|?*+()[]{}/-" else c for c in name)
    return escaped.replace(" ", r"\s+")


def signature_rules() -> list[tuple[str, str, str, int, float]]:
    """(keyword, pattern, label, priority, weight), the most telling forms first.

    Each family gives a rule for its SPDX tag, its notice, its titles with each
    version and without one, and the names of its versions in SPDX form.
    """
    edge, end = r"(?<![a-z0-9])", r"(?![a-z0-9])"
    found = []
    for label, names, stems, versions in FAMILIES:
        for stem in stems:
            found.append(("spdx-license-identifier", rf"spdx-license-identifier:\s*{_spaced(stem)}(-[0-9.]+)?(-only|-or-later|\+)?{end}", label, 90, 1.0))
            for version in versions:
                found.append((f"{stem}-{version}", rf"{edge}{_spaced(stem)}-{_spaced(version)}(-only|-or-later|\+)?{end}", f"{label}-{version}", 70, 0.8))
        for name in names:
            title = _spaced(name)
            found.append((name, rf"licen[sc]ed\s+under\s+(the\s+)?(terms\s+of\s+the\s+)?{title}{end}", label, 60, 0.95))
            for version in versions:
                short = version.removesuffix(".0")
                number = _spaced(version) if short == version else rf"{short}(\.0)?"
                found.append((name, rf"{edge}{title},?\s+(version\s+|v\.?\s*)?{number}(?![0-9]|\.[0-9])", f"{label}-{version}", 50, 0.9))
            found.append((name, rf"{edge}{title}{end}", label, 30, 0.7))
    found += [(keyword, pattern.replace(" ", r"\s+"), label, 80, 0.95) for label, keyword, pattern in SENTENCES]
    return found


def gate_words(rules: list[tuple]) -> list[str]:
    """Short words of which every keyword holds one, so a miss settles a text."""
    common = ["licen", "gpl", "cc", "gfdl", "bsd", "odbl", "cecill", "wtfpl", "spdx", "public domain", "rights reserved",
              "free of charge", "and/or distribute", "redistribution and use", "endorse or promote",
              "free software foundation", "as-is", "creative commons"]
    missed = {k for k, *_ in rules if not any(w in k for w in common)}
    return [*common, *sorted(missed)]


def _literal_rules(rules: list[tuple]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("keyword"), F.lit(p).alias("pattern"), F.lit(label).alias("label"),
                F.lit(pr).alias("priority"), F.lit(w).alias("weight"),
            )
            for k, p, label, pr, w in rules
        ]
    ).cast(_RULE)


_HITS = "array<struct<start:bigint,end:bigint,priority:int,label:string,weight:double>>"
_WALK = f"struct<at:bigint,hits:{_HITS}>"
_SWEEP = f"struct<end:bigint,hits:{_HITS}>"


def _intervals(text: Column, rule: Column) -> Column:
    """All matches of the rule's pattern, placed by the pieces between them."""
    matches = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    pieces = F.split(text, rule["pattern"], -1)
    steps = F.arrays_zip(matches.alias("m"), F.slice(pieces, 1, F.size(matches)).alias("p"))

    def walk(state: Column, step: Column) -> Column:
        start = state["at"] + F.length(step["p"])
        end = start + F.length(step["m"])
        hit = F.struct(
            start.alias("start"), end.alias("end"), rule["priority"].alias("priority"),
            rule["label"].alias("label"), rule["weight"].alias("weight"),
        )
        return F.struct(end.alias("at"), F.concat(state["hits"], F.array(hit)).alias("hits")).cast(_WALK)

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_HITS).alias("hits")).cast(_WALK)
    return F.aggregate(steps, first, walk, lambda s: s["hits"])


def _uncovered(hits: Column) -> Column:
    """Hits that lie in no longer hit, and in no equal one of higher priority."""
    by = lambda x: F.struct(x["start"], -x["end"], -x["priority"], x["label"])
    keyed = F.sort_array(F.transform(hits, lambda x: F.struct(by(x).alias("by"), x.alias("hit"))))

    def sweep(state: Column, item: Column) -> Column:
        hit = item["hit"]
        return (
            F.when(hit["end"] <= state["end"], state)
            .otherwise(F.struct(hit["end"].alias("end"), F.concat(state["hits"], F.array(hit)).alias("hits")).cast(_SWEEP))
            .cast(_SWEEP)
        )

    first = F.struct(F.lit(-1).alias("end"), F.array().cast(_HITS).alias("hits")).cast(_SWEEP)
    return F.aggregate(keyed, first, sweep, lambda s: s["hits"])


def _base_places(words: Column) -> Column:
    """(word index, label) of every place where a base phrase stands."""

    def at(word: Column, i: Column) -> Column:
        label = F.lit(None).cast("string")
        for name, phrase in PHRASES.items():
            rest = [F.coalesce(F.get(words, i + k) == p, F.lit(False)) for k, p in enumerate(phrase) if k]
            label = F.when(reduce(lambda a, b: a & b, rest, word == phrase[0]), name).otherwise(label)
        return F.struct(i.cast("bigint").alias("at"), label.alias("label"))

    return F.filter(F.transform(words, at), lambda x: x["label"].isNotNull())


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``places`` of base phrases, ``detections`` of the rules.

    ``places`` are structs of word index and label, ``detections`` of start, end
    (code points of the lower-cased text), priority, label and weight.
    """
    rules = signature_rules()
    gate = reduce(lambda a, b: a | b, [F.contains(F.col("folded"), F.lit(w)) for w in gate_words(rules)])
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.lower(or_empty(text)).alias("low"),
        F.regexp_count(or_empty(text), F.lit(WORD)).cast("bigint").alias("n_words"),
    )
    rows = rows.withColumn("folded", F.regexp_replace("low", r"\s+", " ")).withColumn("gated", gate)
    worded = rows.withColumn(
        "words", F.when(F.col("gated"), F.array_remove(F.split("low", NOT_WORD), "")).otherwise(F.array().cast("array<string>"))
    )
    active = F.filter(_literal_rules(rules), lambda r: F.contains(F.col("folded"), r["keyword"]))
    hits = F.flatten(F.transform(active, lambda r: _intervals(F.col("low"), r)))
    found = worded.select(
        "doc_id",
        "n_words",
        _base_places(F.col("words")).alias("places"),
        F.when(F.col("gated"), hits).otherwise(F.array().cast(_HITS)).alias("hits"),
    )
    return found.select("doc_id", "n_words", "places", _uncovered(F.col("hits")).alias("detections"))
