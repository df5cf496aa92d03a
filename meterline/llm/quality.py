"""Quality rules: fixed rules, and a log-likelihood ratio of hashed n-grams.

The ratio compares two multinomials over hashed words and word pairs: a trusted target (documents
labelled good and not toxic, a bounded sample of them) and the raw corpus (all documents). A
document's score is its mean log ratio per n-gram; documents below a fixed threshold are rejected,
every document alike. All in DataFrame and SQL functions: n-grams are arrays of hashes, counts are
pre-aggregated to at most ``2^BITS`` rows, and the table of log ratios goes back as one literal.

Defined cases: null text has no words. A document without words has score 0 and fails the fixed
rules. Without trusted documents all ratios are 0. Labels that repeat an id count once; rows of
documents that repeat count each. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import thinned

#: Hash buckets of n-grams, trusted documents at most (expected number), pseudo-count, threshold in nats per n-gram.
BITS = 14
TRUSTED = 20_000
PRIOR = 0.5
THRESHOLD = -0.2
#: Fixed rules, by the query's contract.
FEWEST_WORDS = 10
MOST_REPEATED = 20
SYMBOLS = "#*$%&|<>"
WHITE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE, -1), lambda w: w != "")


def with_hashes(df: DataFrame) -> DataFrame:
    """Adds ``_words`` and ``_hashes``, one 64-bit hash per word of ``text``."""
    df = df.withColumn("_words", words_of(F.col("text")))
    return df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def _bucket(*parts: Column) -> Column:
    h = F.xxhash64(*parts) if len(parts) > 1 else parts[0]
    return h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def trusted_ids(labels: DataFrame, limit: int = TRUSTED) -> DataFrame:
    """Ids of good, not toxic documents: about ``limit`` at most, those of the lowest hashes."""
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    return thinned(good, limit, "doc_id").select(F.col("doc_id").alias("_trusted"))


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """Log ratio of target to raw probability by bucket."""
    ids = F.broadcast(trusted_ids(labels))  # about TRUSTED ids at most
    own = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.join(ids, own["doc_id"] == ids["_trusted"], "left")
    h = F.col("_hashes")
    pairs = F.transform(h, lambda x, i: F.when(i > 0, _bucket(F.get(h, i - 1), x)).otherwise(-1))
    grams = F.concat(F.transform(h, lambda x: _bucket(x)), pairs)
    counted = (
        with_hashes(own)
        .select(F.col("_trusted").isNotNull().cast("long").alias("t"), F.explode(grams).alias("bucket"))
        .filter("bucket >= 0")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("t").alias("target"))
    )
    size = 1 << BITS
    raw, target = [PRIOR] * size, [PRIOR] * size
    for b, r, t in counted.collect():  # at most 2^BITS rows
        raw[b] += r
        target[b] += t
    if sum(target) == PRIOR * size:
        return [0.0] * size
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [round(math.log(t) - math.log(r) + shift, 4) for t, r in zip(target, raw, strict=True)]


def score(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Adds ``score`` to a table with ``_hashes``: mean log ratio of its words and word pairs."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folded to a literal
    h, n = F.col("_hashes"), F.size("_hashes")

    def ratio(*parts: Column) -> Column:
        return F.get(table, _bucket(*parts))

    each = F.transform(
        h, lambda x, i: ratio(x) + F.when(i > 0, ratio(F.get(h, i - 1), x)).otherwise(F.lit(0.0))
    )
    total = F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
    return docs.withColumn("score", F.when(n > 0, total / (2 * n - 1)).otherwise(F.lit(0.0)))


def with_rules(docs: DataFrame) -> DataFrame:
    """Adds the counts of the fixed rules to a table with ``_words`` and ``_hashes``."""
    text = F.coalesce("text", F.lit(""))
    h, n = F.col("_hashes"), F.size("_words")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = (
        docs.withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
        .withColumn("_lines", lines)
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    )
    windows = F.when(
        n >= 5, F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(5)]))
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_windows", windows)
    # Windows in order of their hash: equal ones are neighbours.
    ordered = F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    df = df.withColumn("_twice", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    none = F.array().cast("array<struct<w:bigint,i:int>>")
    df = df.withColumn("_ordered", F.when(F.col("_twice"), ordered).otherwise(none))
    o = F.col("_ordered")

    def repeated(x: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get(o, k - 1)["w"] == x["w"]).otherwise(F.lit(False))
        after = F.coalesce(F.get(o, k + 1)["w"] == x["w"], F.lit(False))
        return before | after

    df = df.withColumn("_starts", F.sort_array(F.transform(F.filter(o, repeated), lambda x: x["i"])))
    s = F.col("_starts")
    covered = F.transform(s, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(s, k + 1) - x, F.lit(5))))
    df = df.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long"))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", failed)


RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]


def _settled(df: DataFrame, *columns: str) -> DataFrame:
    """The columns, computed once: a later filter on them is not pushed below.

    The planner would push it into the arrays they are made of, again and again within itself, and
    not end. It does not push a condition through a column that depends on the row's place.
    """
    return df.select(*columns, F.monotonically_increasing_id().alias("_place")).filter("_place >= 0").drop("_place")


def _judged(df: DataFrame, ratios: list[float], threshold: float) -> DataFrame:
    df = score(with_rules(with_hashes(df)), ratios)
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the fixed rules' counts, ``score`` and ``kept`` for every row."""
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return _settled(_judged(own, log_ratios(docs, labels), threshold), "doc_id", *RULES)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass."""
    own = docs.select(F.struct("*").alias("_row"), F.col("text").cast("string").alias("text"))
    judged = _settled(_judged(own, log_ratios(docs, labels), threshold), "_row", "kept")
    return judged.filter("kept").select("_row.*")
