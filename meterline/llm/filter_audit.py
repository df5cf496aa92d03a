"""Filter interaction audit: what each of five filters removes in each of their 120 orders.

Failing documents are found once per filter, not once per order. Filters A to D read one document
each. E, a copy of a smaller id's text, is an existential self-join: a left-semi join on the text's
hash, the text itself and a smaller id. The right side has one row per text, pre-aggregated; the left
side only rows whose hash may occur twice, by a bit table of fixed size; texts with many copies are
spread over salts, so neither side gathers a group in one task. The failing ids of all filters are
united into one bit set per document, and everything else follows from the counts of bit sets.

Defined cases: a null text is an empty one. A null id is neither smaller nor larger than any other,
so its row never fails E and makes no other row fail it. Rows that repeat an id count each; rows of
one id and text are no copies of each other. A document is of good quality (toxic) if any of its
labels says so; rows without an id have no labels. Null languages count under the empty string. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The filters in the order of their bits, and their thresholds by the query's contract.
FILTERS = "ABCDE"
FEWEST_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
SYMBOLS = "[#$%&*|]"
WHITE = r"[\x20\x09-\x0D]+"
COPY = 1 << FILTERS.index("E")

#: Words of 64 bits in the table of repeated hashes; beyond its load more rows pass it, at a cost in time only.
TABLE_WORDS = 1 << 18
#: A text with more than 1/PIECES of all rows is dealt over salts; there are at most PIECES such texts.
PIECES = 1000


def own_failures(text: Column, words: Column) -> Column:
    """Bits of the filters A to D."""
    n = F.size(words)
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {
        "A": n < FEWEST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n,
        "C": 100 * upper > UPPER_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }
    bits = [F.when(cond, F.lit(1 << FILTERS.index(f))).otherwise(F.lit(0)) for f, cond in fails.items()]
    return sum(bits[1:], bits[0])


def copies(rows: DataFrame) -> DataFrame:
    """Rows of (doc_id, part, text, _hash) whose text a smaller id has too, as (doc_id, part, _hash)."""
    total = rows.count()
    repeated = rows.groupBy("_hash").agg(F.count("*").alias("n")).filter("n > 1")
    bit = F.expr(f"cast(shiftright(_hash, {TABLE_WORDS.bit_length() - 1}) & 63 as int)")
    word = F.expr(f"_hash & {TABLE_WORDS - 1}L")
    table = repeated.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    hot = repeated.filter(F.col("n") * PIECES >= total).select(
        "_hash", F.least("n", F.ceil(F.col("n") * PIECES / F.lit(float(max(total, 1))))).cast("int").alias("_salts")
    )
    # Both broadcasts are of bounded size: TABLE_WORDS rows, and PIECES rows.
    suspects = (
        rows.filter("doc_id is not null")
        .withColumn("_word", word)
        .join(F.broadcast(table), "_word")
        .filter(F.call_function("getbit", "_bits", bit) == 1)
        .select("doc_id", "part", "text", "_hash")
    )
    salts = F.coalesce("_salts", F.lit(1))
    dealt = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), salts).cast("int")
    left = suspects.join(F.broadcast(hot), "_hash", "left").withColumn("_salt", dealt)
    first = suspects.groupBy("_hash", "text").agg(F.min("doc_id").alias("first"))
    first = first.join(F.broadcast(hot), "_hash", "left").select(
        F.col("_hash").alias("h"), F.col("text").alias("t"), "first", F.explode(F.sequence(F.lit(0), salts - 1)).alias("s")
    )
    same = (F.col("_hash") == F.col("h")) & (F.col("text") == F.col("t")) & (F.col("_salt") == F.col("s"))
    return left.join(first, same & (F.col("first") < F.col("doc_id")), "left_semi").select("doc_id", "part", "_hash")


def bit_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and set of failed filters."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    words = F.array_remove(F.split("text", WHITE, -1), "")
    own = rows.withColumn("_words", words).select(
        "doc_id", "part", "_hash", own_failures(F.col("text"), F.col("_words")).alias("mask"), F.lit(1).cast("long").alias("n")
    )
    late = copies(rows).select("*", F.lit(COPY).alias("mask"), F.lit(0).cast("long").alias("n"))
    masks = own.union(late).groupBy("doc_id", "part", "_hash").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    # Rows without an id meet no label; their number keeps them from meeting in one task.
    lone = F.when(F.col("doc_id").isNull(), F.pmod("_hash", F.lit(PIECES)) + 1).otherwise(0).alias("_lone")
    flags = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(*[F.max(F.expr(f"int({c} <=> 1)")).alias(name) for c, name in (("quality", "_good"), ("toxic", "_toxic"))])
        .withColumn("_none", F.lit(0).cast("long"))
    )
    known = masks.withColumn("_lone", lone)
    known = known.join(flags, (F.col("doc_id") == F.col("_id")) & (F.col("_lone") == F.col("_none")), "left")
    return known.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(f"_{k}", F.lit(0))).alias(k) for k in ("good", "toxic")]
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique, lost and Shapley counts."""
    cells = F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    parts = bit_counts(docs, labels).groupBy("part").agg(cells)  # at most 32 cells
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = parts.withColumn("filter_order", F.explode(F.lit(orders))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )
    letter = F.expr("substr(filter_order, step, 1)")
    bit = "shiftleft(1, ascii({}) - ascii('A'))"
    before = f"aggregate(sequence(0, step - 1), 0, (a, i) -> if(i = 0, a, a | {bit.format('substr(filter_order, i, 1)')}))"
    steps = steps.select("*", letter.alias("_filter"), F.expr(before).alias("_before")).withColumn("_bit", F.expr(bit.format("_filter")))

    def total(of: str, when: str, name: str) -> Column:
        return F.expr(f"aggregate(filter(cells, c -> {when}), 0L, (a, c) -> a + c.{of})").alias(name)

    here = "c.mask & _bit != 0 and c.mask & _before = 0"
    out = steps.select(
        "part",
        "filter_order",
        "step",
        "_filter",
        total("n", "c.mask & (_before | _bit) = 0", "kept"),
        total("n", here, "removed"),
        total("n", "c.mask & _bit != 0 and c.mask & _before != 0", "redundant"),
        total("n", "c.mask = _bit", "unique_fails"),
        total("good", here, "good_lost"),
        total("toxic", here, "toxic_lost"),
    )
    whole = Window.partitionBy("part", "_filter")  # 120 rows
    return out.withColumn("shapley", F.sum("removed").over(whole)).drop("_filter")
