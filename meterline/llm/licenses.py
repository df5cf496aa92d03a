"""License scan: ordered signature rules over normalised words.

A text is lower-cased (A-Z) and brought to words joined by single spaces. Every rule is a regular
expression over that form with a keyword. A document's words select the rules whose keyword they
hold; only those run. Each match is an interval of words with the rule's priority. An interval that
lies within another of higher priority, or within a longer one (or an earlier rule's equal one) of
the same priority, is suppressed. Rules are written by hand for license texts, notices and links
(``license_rules``, highest priority); a table of licenses and templates for how they are named
follows, the most explicit forms first. Further operands of an SPDX expression are rules of their own.
The fixed phrases of the query's contract stand beside them and are never suppressed.

All in DataFrame and SQL functions, row by row without a shuffle; the rule table is one literal.

Defined cases: null text is empty; a text without words has no matches, null positions, empty
labels and score 0. Repeated rows are each returned. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import KINDS

#: Fixed phrases, by the query's contract.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Label, name as words (a regular expression), keyword every match holds.
LICENSES = (
    ("mit", "mit", "mit"),
    ("mit-0", "mit (?:no attribution|0)", "mit"),
    ("apache-1.1", "apache (?:software )?(?:license )?(?:version )?1 1", "apache"),
    ("apache-2", "apache (?:software )?(?:license )?(?:version |v)?2(?: 0)?", "apache"),
    ("gpl-2", "(?:gnu )?(?<!affero )(?<!lesser )(?<!library )general public license (?:version |v)?2(?: 0)?", "general"),
    ("gpl-2", "(?:gnu )?gpl (?:version |v)?2(?: 0)?", "gpl"),
    ("gpl-2", "gplv2", "gplv2"),
    ("gpl-3", "(?:gnu )?(?<!affero )(?<!lesser )general public license (?:version |v)?3(?: 0)?", "general"),
    ("gpl-3", "gpl (?:version |v)?3(?: 0)?", "gpl"),
    ("gpl-3", "gplv3", "gplv3"),
    ("lgpl-2.1", "(?:gnu )?(?:lesser|library) general public license (?:version |v)?2 1", "general"),
    ("lgpl-2.1", "lgpl (?:version |v)?2 1", "lgpl"),
    ("lgpl-3", "(?:gnu )?lesser general public license (?:version |v)?3(?: 0)?", "lesser"),
    ("lgpl-3", "lgpl (?:version |v)?3(?: 0)?", "lgpl"),
    ("agpl-3", "(?:gnu )?affero general public license (?:version |v)?3(?: 0)?", "affero"),
    ("agpl-3", "agpl (?:version |v)?3(?: 0)?", "agpl"),
    ("bsd-2", "(?:bsd 2 clause|2 clause bsd)", "clause"),
    ("bsd-2", "freebsd", "freebsd"),
    ("bsd-2", "(?:simplified bsd|bsd 2)", "bsd"),
    ("bsd-3", "(?:bsd 3 clause|3 clause bsd|modified bsd|new bsd|revised bsd)", "bsd"),
    ("bsd-4", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd"),
    ("0bsd", "0bsd", "0bsd"),
    ("0bsd", "(?:bsd zero clause|zero clause bsd)", "zero"),
    ("isc", "isc", "isc"),
    ("mpl-1.1", "mozilla public license (?:version |v)?1 1", "mozilla"),
    ("mpl-2", "mozilla public license (?:version |v)?2(?: 0)?", "mozilla"),
    ("mpl-2", "mpl (?:version |v)?2(?: 0)?", "mpl"),
    ("epl-1", "eclipse public license (?:version |v)?1(?: 0)?", "eclipse"),
    ("epl-2", "eclipse public license (?:version |v)?2(?: 0)?", "eclipse"),
    ("cddl-1", "common development and distribution license", "distribution"),
    ("eupl-1.2", "european union public licen[cs]e", "european"),
    ("ofl-1.1", "sil open font license", "sil"),
    ("bsl-1", "boost software license", "boost"),
    ("zlib", "zlib", "zlib"),
    ("artistic-2", "artistic license 2(?: 0)?", "artistic"),
    ("artistic-1", "artistic license 1(?: 0)?", "artistic"),
    ("postgresql", "postgresql", "postgresql"),
    ("psf-2", "python software foundation", "python"),
    ("unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", "do what the fuck you want to public license", "fuck"),
    ("ms-pl", "microsoft public license", "microsoft"),
    ("ms-rl", "microsoft reciprocal license", "microsoft"),
    ("odbl", "open database license", "database"),
    ("odc-by", "open data commons attribution license", "commons"),
    ("pddl", "public domain dedication and license", "dedication"),
    ("cc0", "cc0", "cc0"),
    ("cc0", "(?:cc zero|creative commons zero)", "zero"),
    ("cc-by", "cc by", "cc"),
    ("cc-by-sa", "cc by sa", "cc"),
    ("cc-by-nc", "cc by nc", "cc"),
    ("cc-by-nd", "cc by nd", "cc"),
    ("cc-by-nc-sa", "cc by nc sa", "cc"),
    ("cc-by-nc-nd", "cc by nc nd", "cc"),
    ("cc-by", "creative commons attribution", "creative"),
    ("cc-by-sa", "creative commons attribution share ?alike", "creative"),
    ("cc-by-nc", "creative commons attribution non ?commercial", "creative"),
    ("cc-by-nd", "creative commons attribution no ?derivatives", "creative"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", "creative"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?derivatives", "creative"),
    ("public-domain", "public domain", "domain"),
)
#: Priority, confidence and form; N stands for a license's name. Bare forms need no other word.
TEMPLATES = (
    (5, 1.0, "spdx license identifier N(?: only| or later)?"),
    (
        4,
        0.95,
        "(?:licensed|released|distributed|published|available|provided|covered|governed) (?:under|by) "
        "(?:the )?(?:terms of )?(?:the )?N(?: licen[cs]e)?(?: (?:version |v)?[0-9]+(?: [0-9]+)?)?(?: international)?",
    ),
    (3, 0.85, "(?:subject to|terms of|conditions of|pursuant to|under) (?:the )?N(?: licen[cs]e)?"),
    (2, 0.7, "(?:the )?N licen[cs]e"),
)
#: A later operand of an SPDX expression: a name after "or" or "and" some words behind the identifier's start.
SPDX_OPERAND = "(?<=spdx license identifier [a-z0-9. ]{1,60} (?:or|and) )N(?: only| or later)?"
#: Names clear enough to stand alone (they hold a version or are no common word).
BARE_PRIORITY, BARE_CONFIDENCE = 1, 0.5
COMMON = frozenset({"mit", "isc", "zlib", "postgresql", "psf-2", "public-domain", "mit-0"})


def rule_table() -> list[dict]:
    """All rules in order: fixed phrases, written signatures, templates by license, bare names."""
    rules = [
        {"label": label, "pattern": phrase, "keyword": key, "priority": 9, "confidence": 1.0, "base": True}
        for (phrase, label), key in zip(PHRASES, ("mit", "apache", "cc"), strict=True)
    ]
    for priority, confidence, signatures in KINDS:
        rules += [
            {"label": label, "pattern": pattern, "keyword": key, "priority": priority, "confidence": confidence, "base": False}
            for label, key, pattern in signatures
        ]
    rules += [
        {"label": label, "pattern": SPDX_OPERAND.replace("N", f"(?:{name})"), "keyword": "spdx", "priority": 5, "confidence": 1.0, "base": False}
        for label, name, _ in LICENSES
    ]
    for priority, confidence, form in TEMPLATES:
        rules += [
            {"label": label, "pattern": form.replace("N", f"(?:{name})"), "keyword": key, "priority": priority, "confidence": confidence, "base": False}
            for label, name, key in LICENSES
        ]
    rules += [
        {"label": label, "pattern": name, "keyword": key, "priority": BARE_PRIORITY, "confidence": BARE_CONFIDENCE, "base": False}
        for label, name, key in LICENSES
        if label not in COMMON
    ]
    return [r | {"rank": i, "pattern": f"(?<= ){r['pattern']}(?= )"} for i, r in enumerate(rules)]


RULE_TYPE = (
    "array<struct<label:string,pattern:string,keyword:string,priority:int,confidence:double,base:boolean,rank:int>>"
)
PRIORITIES = range(1, 10)


def normalised(text: Column) -> Column:
    """Words joined by single spaces, with a space at both ends."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    low = F.translate(F.coalesce(text, F.lit("")), upper, lower)
    return F.regexp_replace(F.concat(F.lit("."), low, F.lit(".")), SEPARATORS, " ")


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


#: Elements handled at once where an array is read in order.
CHUNK = 256


def running(items: Column, zero: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Reads an array in order with a state; the joined results.

    ``step`` takes state and element and gives the next state and an array of ``kind``. An array that grows
    by one element a time is copied whole each time, so results grow in chunks, and chunks are joined: n
    elements cost some n * CHUNK copies, not n * n. The array is bound once, so that it's computed once.
    """

    def chunk(state: Column, part: Column) -> Column:
        start = F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))

        def one(a: Column, x: Column) -> Column:
            after, more = step(a["state"], x)
            return F.struct(after.alias("state"), F.concat(a["out"], more).alias("out"))

        return F.aggregate(part, start, one)

    def whole(every: Column) -> Column:
        start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))

        def one(a: Column, at: Column) -> Column:
            done = F.array(chunk(a["state"], F.slice(every, at, CHUNK)))
            return F.get(
                F.transform(done, lambda r: F.struct(r["state"].alias("state"), F.concat(a["out"], F.array(r["out"])).alias("out"))), 0
            )

        chunks = F.sequence(F.lit(1), F.greatest(F.size(every), F.lit(1)), F.lit(CHUNK))
        return F.flatten(F.aggregate(chunks, start, one)["out"])

    return F.get(F.transform(F.array(items), whole), 0)


def _intervals(norm: Column, rule: Column) -> Column:
    """Intervals of a rule's matches: the text between them tells how many words come before."""
    matched = F.transform(F.regexp_extract_all(norm, rule["pattern"], F.lit(0)), lambda m: _spaces(m) + 1)
    gaps = F.transform(F.split(norm, rule["pattern"], -1), _spaces)
    # A match of w words takes w - 1 spaces; the text's first space precedes word 0.
    steps = F.zip_with(gaps, matched, lambda g, w: F.struct(g.alias("g"), w.alias("w")))

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        start = at + s["g"]
        return start + s["w"] - 1, F.array(F.struct(start.alias("start"), (start + s["w"]).alias("end")))

    start = running(F.filter(steps, lambda s: s["w"].isNotNull()), F.lit(-1), "struct<start:int,end:int>", step)
    return F.transform(
        start,
        lambda x: F.struct(
            x["start"].alias("start"),
            (-x["end"]).alias("minus_end"),
            (-rule["priority"]).alias("minus_priority"),
            rule["rank"].alias("rank"),
            rule["label"].alias("label"),
            rule["confidence"].alias("confidence"),
            rule["base"].alias("base"),
        ),
    )


def _unsuppressed(found: Column) -> Column:
    """The intervals (in order of start, then longest first) that lie within no stronger one.

    What begins earlier, or begins there and is longer, contains an interval if it ends no sooner. So
    the furthest end so far of each priority tells, in one pass.
    """
    reach = F.array(*[F.lit(-1) for _ in PRIORITIES])

    def step(a: Column, d: Column) -> tuple[Column, Column]:
        priority, end = -d["minus_priority"], -d["minus_end"]
        inside = F.exists(F.transform(a, lambda r, k: (k + 1 >= priority) & (r >= end)), lambda x: x)
        after = F.transform(a, lambda r, k: F.when(k + 1 == priority, F.greatest(r, end)).otherwise(r))
        return after, F.filter(F.array(d), lambda _: ~inside)

    return running(found, reach, INTERVAL, step)


INTERVAL = "struct<start:int,minus_end:int,minus_priority:int,rank:int,label:string,confidence:double,base:boolean>"


def _settled(df: DataFrame, *columns: str) -> DataFrame:
    """The columns, computed once: the planner does not copy them into what is made of them later.

    It moves no expression through a condition on the row's place.
    """
    return df.select(*columns, F.monotonically_increasing_id().alias("_place")).filter("_place >= 0").drop("_place")


def detect(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_words, base, found``: intervals of the fixed phrases and those left of all rules.

    Both are arrays of ``start, end, label, rank, confidence`` in words, ends exclusive.
    """
    rules = rule_table()
    literal = F.from_json(F.lit(json.dumps(rules)), RULE_TYPE)
    keywords = sorted({r["keyword"] for r in rules})
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col).cast("string")).alias("_norm"))
    df = df.withColumn("n_words", (_spaces(F.rtrim("_norm"))).cast("long"))
    gate = F.col("_norm").rlike(" (?:" + "|".join(keywords) + ") ")
    held = F.array_intersect(F.split("_norm", " "), F.array(*map(F.lit, keywords)))
    df = df.withColumn("_held", F.when(gate, held).otherwise(F.array().cast("array<string>")))
    norm = F.col("_norm")
    chosen = F.filter(literal, lambda r: F.array_contains(F.col("_held"), r["keyword"]))
    every = F.sort_array(F.flatten(F.transform(chosen, lambda r: _intervals(norm, r))))
    empty = F.array().cast(f"array<{INTERVAL}>")
    df = _settled(df.withColumn("_every", F.when(F.size("_held") > 0, every).otherwise(empty)), "doc_id", "n_words", "_every")
    df = df.withColumn("_base", F.filter("_every", lambda d: d["base"]))
    method = F.filter("_every", lambda d: ~d["base"])
    df = df.withColumn("_left", F.when(F.size("_every") > 0, _unsuppressed(method)).otherwise(empty))
    df = _settled(df, "doc_id", "n_words", "_base", "_left")

    def public(a: Column) -> Column:
        return F.transform(
            a,
            lambda d: F.struct(
                d["start"].alias("start"),
                (-d["minus_end"]).alias("end"),
                d["label"].alias("label"),
                d["rank"].alias("rank"),
                d["confidence"].alias("confidence"),
            ),
        )

    return df.select("doc_id", "n_words", public(F.col("_base")).alias("base"), public(F.col("_left")).alias("found"))


def _labels(*spans: Column) -> Column:
    names = [F.transform(s, lambda d: d["label"]) for s in spans]
    return F.array_join(F.sort_array(F.array_distinct(reduce(F.concat, names))), ",")


def label_digests(docs: DataFrame) -> DataFrame:
    base, found = F.col("base"), F.col("found")
    starts = F.transform(base, lambda d: d["start"].cast("long"))
    sure = F.array_max(F.transform(F.concat(base, found), lambda d: d["confidence"]))
    return detect(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(base, found).alias("labels"),
        F.coalesce(sure, F.lit(0.0)).alias("score"),
    )
