"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be copied ``target / source_size`` times, at least and at most the
whole numbers next to it. The fractional parts are rounded dependently: of two documents one takes
words from the other, at random and without change of the expected copies, until one of the two is
integral. The words of both together stay the same, so a whole source's words do, up to the rounding
of one last document.

The pairing is a reduction tree over hash prefixes. On the lowest level a node holds some 64 documents
of all sources, each source's by themselves, and hands at most one undecided document per source on;
each level above joins 64 nodes. A source's size or hotness changes the number of its nodes, never a
node's size. Within a node documents go from the largest to the smallest, so that what stays undecided is small.

Defined cases: a null text has size 0, and a document of size 0 is taken with 0 words. Null sources
count as one, after all others. Rows alike in id, source and size are one unit of the tree, since the
result can't tell them apart; of its rows as many get one more copy as the tree says. If all sizes are
0 all targets are 0. An empty table gives no rows. Draws are hashes of the documents, so reruns agree
however the rows are partitioned. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .textops import write_table

#: Weights of the sources by code point, repeating; most copies; words end at ASCII white space.
WEIGHTS = (5, 2, 1)
MOST = 3
WHITE = r"[\x20\x09-\x0D]+"

#: Hash bits per tree level: about 64 units per node, and 64 nodes below each node.
FAN_BITS = 6
#: Ways a source's facts are repeated, so that a hot source's rows meet them in many tasks.
SPREAD = 64


def n_words(text: Column) -> Column:
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), WHITE, -1)
    return F.size(F.array_remove(parts, "")).cast("long")


def units_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, rows): documents, those alike in all three counted."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size")).groupBy("doc_id", "source", "size").agg(
        F.count("*").alias("rows")
    )


def targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_no, source_size, target), one row per source.

    Sources fill up in the order of their size per weight; a source is full if its limit is below its
    share of what the sources before it left. All is decided in integers. The windows run over the
    sources, one row each.
    """
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    big = "decimal(38,0)"
    known = sizes.withColumn("source_no", place).withColumn("weight", weight.cast(big))
    known = known.withColumn("limit", (F.col("source_size") * most).cast(big))
    # limit / weight orders sources; weights are small, so limit times the others' product orders them in integers.
    product = math.prod(set(weights))
    by_fill = Window.orderBy((F.col("limit") * (F.lit(product) / F.col("weight")).cast(big)).asc(), "source_no")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything).cast(big)
    sums = known.select(
        "*",
        (total - F.coalesce(F.sum("limit").over(before), F.lit(0))).cast(big).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast(big).alias("open"),
    )
    full = sums.withColumn("full", F.col("limit") * F.col("open") < F.col("left") * F.col("weight"))
    rest = full.select(
        "*",
        F.min(F.when(~F.col("full"), F.struct(-F.col("open"), F.col("left").alias("left")))).over(everything).alias("_rest"),
    )
    share = F.col("_rest.left").cast("double") * F.col("weight").cast("double") / -F.col("_rest.col1").cast("double")
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share)
    return rest.select("source", F.col("source_no").cast("long").alias("source_no"), "source_size", target.alias("target"))


def with_facts(units: DataFrame, facts: DataFrame) -> DataFrame:
    """Units with the facts of their source; a hot source's rows are spread over ``SPREAD`` keys."""
    ways = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    right = facts.select(
        F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name"), ways.alias("_way"),
        "source_no", "source_size", "target",
    )
    left = units.select(
        "*",
        F.col("source").isNull().alias("_none"),
        F.coalesce("source", F.lit("")).alias("_name"),
        F.pmod("hash", F.lit(SPREAD)).cast("int").alias("_way"),
    )
    return left.join(right, ["_none", "_name", "_way"]).drop("_none", "_name", "_way", "source")


#: One step of the tree within a node. ``s.open`` is the undecided unit so far (null at first), ``x`` the next;
#: up and down are the words that ``open`` can take from and give to ``x``. Going up with the chance
#: down / (up + down) leaves both units' expected copies as they are. ``x.u`` is the draw.
_STEP = """
  case
    when s.open is null then named_struct('open', struct(x.hash as hash, x.size as size, x.p as p), 'done', s.done)
    when x.u * (least((1 - s.open.p) * s.open.size, x.p * x.size) + least(s.open.p * s.open.size, (1 - x.p) * x.size))
         < least(s.open.p * s.open.size, (1 - x.p) * x.size) then
      case when (1 - s.open.p) * s.open.size <= x.p * x.size
        then named_struct('open', struct(x.hash as hash, x.size as size,
            greatest(0e0, x.p - (1 - s.open.p) * s.open.size / x.size) as p),
          'done', concat(s.done, array(struct(s.open.hash as hash, s.open.size as size, 1 as bit))))
        else named_struct('open', struct(s.open.hash as hash, s.open.size as size,
            least(1e0, s.open.p + x.p * x.size / s.open.size) as p),
          'done', concat(s.done, array(struct(x.hash as hash, x.size as size, 0 as bit)))) end
    else
      case when s.open.p * s.open.size <= (1 - x.p) * x.size
        then named_struct('open', struct(x.hash as hash, x.size as size,
            least(1e0, x.p + s.open.p * s.open.size / x.size) as p),
          'done', concat(s.done, array(struct(s.open.hash as hash, s.open.size as size, 0 as bit))))
        else named_struct('open', struct(s.open.hash as hash, s.open.size as size,
            greatest(0e0, s.open.p - (1 - x.p) * x.size / s.open.size) as p),
          'done', concat(s.done, array(struct(x.hash as hash, x.size as size, 1 as bit)))) end
  end
"""
_STATE = (
    "struct<open: struct<hash: bigint, size: bigint, p: double>, "
    "done: array<struct<hash: bigint, size: bigint, bit: int>>>"
)
_NODE = f"""
  aggregate(
    sort_array(collect_list(struct(-size as neg, hash, size, p, u))),
    cast(named_struct('open', null, 'done', array()) as {_STATE}),
    (s, x) -> cast({_STEP} as {_STATE}))
"""


def _draw(level: int) -> Column:
    """A uniform draw of a unit on a level, in [0, 1)."""
    return F.expr(f"shiftrightunsigned(xxhash64(hash, source_no, {level}), 11) / 9007199254740992e0").alias("u")


def _reduce(open_units: DataFrame, bits: int, level: int) -> DataFrame:
    """One level: (source_no, node, state), the node being the first ``bits`` bits of the units' hashes."""
    node = F.expr(f"shiftrightunsigned(hash, {64 - bits})" if bits else "0L").alias("node")
    return open_units.select("source_no", node, "hash", "size", "p", _draw(level)).groupBy("source_no", "node").agg(
        F.expr(_NODE).alias("state")
    )


def rounded(fractions: DataFrame) -> DataFrame:
    """(source_no, hash, size, bit) for units (source_no, hash, size, p) with 0 < p < 1 and a positive size.

    Hash and size name a unit of a source.
    """
    spark = fractions.sparkSession
    bits = FAN_BITS * max(0, math.ceil(math.log2(max(1, fractions.count() >> FAN_BITS)) / FAN_BITS))
    level, decided, todo = 0, None, fractions
    while True:
        states = write_table(_reduce(todo, bits, level), scratch_path(spark, "mixing-level"))
        done = states.select("source_no", F.inline("state.done"))
        decided = done if decided is None else decided.union(done)
        todo = states.select("source_no", "state.open.*")
        if bits == 0:
            break
        bits, level = bits - FAN_BITS, level + 1
    last = todo.select("source_no", "hash", "size", "p", _draw(level + 1)).selectExpr("source_no", "hash", "size", "int(u < p) as bit")
    return decided.union(last)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per row: doc_id, size, source_size, target, copies and taken words."""
    spark = docs.sparkSession
    units = write_table(units_of(docs), scratch_path(spark, "mixing-units"))
    facts = write_table(targets(units, weights, most), scratch_path(spark, "mixing-facts"))
    # For one source and size the hash of a long id is one to one, so with the size it names a unit.
    named = with_facts(units.withColumn("hash", F.xxhash64("source", "size", "doc_id")), facts)
    rate = F.coalesce(F.expr("try_divide(target, source_size)"), F.lit(0.0))
    whole = F.floor("rate")
    extra = F.col("rows") * (F.col("rate") - F.col("least"))
    planned = (
        named.withColumn("rate", rate)
        .withColumn("least", whole)
        .withColumn("more", F.when(F.col("size") > 0, extra).otherwise(0.0))
        .withColumn("sure", F.floor("more"))
        .withColumn("p", F.col("more") - F.col("sure"))
    )
    planned = write_table(planned.drop("rate", "more"), scratch_path(spark, "mixing-plan"))
    bits = rounded(planned.filter("p > 0").select("source_no", "hash", "size", "p")).filter("bit = 1")
    copies = F.col("least") + F.when(F.col("i") <= F.col("sure") + F.coalesce("bit", F.lit(0)), 1).otherwise(0)
    return (
        planned.join(bits, ["source_no", "hash", "size"], "left")
        .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .withColumn("copies", copies)
        .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
