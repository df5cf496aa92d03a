"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words: positions marked 0 are ignored, so a substituted
word there leaves the seed intact. Every document is hashed with every mask at every word. A bit
table of fixed size, made of all benchmark seeds, passes the few seeds worth joining; the words
around them go along as a region (regions of equal words are looked at once). Region seeds are
joined with benchmark seeds on the hash, which gives alignments (region, item, offset), and each
alignment is verified word by word: the best-scoring stretch, with a substitution costing two
matches, must match ``MIN_MATCH`` words, or four fifths of a shorter item.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Two masks are lighter: with them, items of up to 14
words are found at every placing of substitutions that the verification takes, longer ones at 98 in 100
or more for each number of substitutions; runs of one word less are sought of 5 or 6 words, and shorter
items as a whole. A stretch is followed up to
``REACH`` words from its seeds; longer overlaps have seeds of their own and are merged.

Defined cases: null or empty texts on either side match nothing. Repeated rows of an item or a
document give one row per pair of ids. Null ids are kept as they are. Other columns are ignored.
An empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .textops import _PLACE, bit_table, map_rows, mix, text_key, word_hashes, write_table

#: The masks that select seven words.
MASKS = ("1111111", "1101011011", "110010110011", "1010011001011")
WEIGHT = 7
#: The masks that select five.
LIGHT = ("110111", "11100011")
#: Words that an overlap must match, and what a substitution costs in matches.
MIN_MATCH = 12
COST = 2
#: Words kept on each side of a seed.
REACH = 48
#: Bits of the table of benchmark seeds (4 MB) and bits a seed sets.
TABLE_BITS = 25
PROBES = 3


def seed_hashes(words: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The seed of each word the mask fits at."""
    count = len(words) - len(mask) + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(count, salt + 1, dtype=np.uint64)
    for k, at in enumerate(i for i, c in enumerate(mask) if c == "1"):
        out += words[at : at + count] * _PLACE[k]
    return mix(out)


def all_masks() -> list[tuple[str, int]]:
    """Masks with their salts; runs of fewer than ``WEIGHT`` words first, the light ones last."""
    short = ["1" * n for n in range(1, WEIGHT)]
    return [(m, i) for i, m in enumerate([*short, *MASKS, *LIGHT])]


def masks_of(n: int) -> list[tuple[str, int]]:
    """The masks of an item of ``n`` words."""
    if n < WEIGHT:
        # Of 5 and 6 words one may differ: at an end, or the third of 6. Of fewer words none.
        run = n if n < 5 else n - 1
        return [(m, s) for m, s in all_masks() if m == "1" * run or n == 6 and m == LIGHT[0]]
    every = all_masks()[WEIGHT - 1 :]
    return [(m, s) for m, s in every if len(m) <= n]


def _places(seed: np.ndarray, bits: int) -> list[np.ndarray]:
    low = np.uint64((1 << bits) - 1)
    return [((seed >> np.uint64(s)) & low).astype(np.int64) for s in (0, 19, 38)[:PROBES]]


def _item_step(rows: Iterator[tuple]) -> Iterator[tuple]:
    for item_id, text in rows:
        words = word_hashes(text)
        masks = masks_of(len(words))
        body = words.tobytes()
        for mask, salt in masks:
            for at, seed in enumerate(seed_hashes(words, mask, salt).view(np.int64).tolist()):
                yield item_id, salt, seed, at, body if at == 0 and salt == masks[0][1] else None


def _region_step(table, salts: set[int]):
    """Regions of a document's words around the seeds, of the masks in use, that the table passes."""
    masks = [(m, s) for m, s in all_masks() if s in salts]

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        bits = table.value
        for doc_id, key, text in rows:
            words = word_hashes(text)
            found_at, found = [], []
            for mask, salt in masks:
                seed = seed_hashes(words, mask, salt)
                at = np.arange(len(seed))
                for place in _places(seed, TABLE_BITS):
                    hit = bits[place[at] >> 5] >> (place[at] & 31).astype(np.uint32) & 1 == 1
                    at = at[hit]
                    if not len(at):
                        break
                if len(at):
                    found_at.append(at)
                    found.append(seed[at])
            if not found:
                continue
            at, seed = np.concatenate(found_at), np.concatenate(found)
            order = np.argsort(at, kind="stable")
            at, seed = at[order], seed[order]
            cuts = np.flatnonzero(np.diff(at) > 2 * REACH) + 1
            for own_at, own in zip(np.split(at, cuts), np.split(seed, cuts), strict=True):
                start = max(0, int(own_at[0]) - REACH)
                part = words[start : int(own_at[-1]) + REACH]
                name = mix(part * np.uint64(3) + np.arange(len(part), dtype=np.uint64)).sum(dtype=np.uint64)
                yield (
                    doc_id,
                    key,
                    start,
                    int(np.uint64(name).astype(np.int64)),
                    part.tobytes(),
                    own.view(np.int64).tolist(),
                    (own_at - start).tolist(),
                )

    return step


def best_stretch(same: np.ndarray, cost: int = COST) -> tuple[int, int, int]:
    """Matches, start and end (exclusive) of the best stretch: +1 a match, -cost a substitution."""
    score = np.concatenate([[0], np.cumsum(np.where(same, 1, -cost))])
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.argmin(score[: end + 1]))
    return int(same[start:end].sum()), start, end


def _verify_step(rows: Iterator[tuple]) -> Iterator[tuple]:
    for region, item_id, offset, region_words, item_words in rows:
        doc, item = np.frombuffer(region_words, dtype=np.uint64), np.frombuffer(item_words, dtype=np.uint64)
        # Item word i stands at region word i + offset.
        first, last = max(0, -offset), min(len(item), len(doc) - offset)
        if last <= first:
            continue
        same = item[first:last] == doc[first + offset : last + offset]
        matched, start, end = best_stretch(same)
        if matched >= min(MIN_MATCH, -(-4 * len(item) // 5)):
            yield region, item_id, matched, first + start, end - start, first + start + offset


def _overlapping(docs: DataFrame, items: DataFrame, id_col, item_col, text_col) -> DataFrame:
    """Every overlap found: id and key of the document, the item, and the stretch."""
    spark = docs.sparkSession
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    seeds = map_rows(items, _item_step, "item_id long, salt int, seed long, at int, body binary")
    seeds = write_table(seeds, scratch_path(spark, "decontam-items"))
    low = (1 << TABLE_BITS) - 1
    places = F.array(*[F.shiftrightunsigned("seed", s).bitwiseAND(F.lit(low)) for s in (0, 19, 38)[:PROBES]])
    table = spark.sparkContext.broadcast(bit_table(seeds.select(F.explode(places).alias("place")), TABLE_BITS))
    salts = {r["salt"] for r in seeds.select("salt").distinct().collect()}

    schema = "doc_id long, key long, start int, region long, words binary, seeds array<long>, places array<int>"
    own = docs.select(F.col(id_col).cast("long"), text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string"))
    regions = map_rows(own, _region_step(table, salts), schema)
    regions = write_table(regions, scratch_path(spark, "decontam-regions"))

    # Regions of the same words have the same seeds.
    unlike = regions.groupBy("region").agg(
        F.first("words").alias("words"), F.first(F.arrays_zip("seeds", "places")).alias("hits")
    )
    hits = unlike.select("region", F.explode("hits").alias("hit")).select("region", "hit.seeds", "hit.places")
    bodies = seeds.filter("body is not null").groupBy("item_id", "body").agg(F.lit(1).alias("_one"))
    aligned = (
        hits.join(seeds.select("item_id", "seed", "at"), F.col("seeds") == F.col("seed"))
        .select("region", "item_id", (F.col("places") - F.col("at")).alias("offset"))
        .distinct()
    )
    pairs = aligned.join(unlike.select("region", "words"), "region").join(
        bodies.withColumnRenamed("item_id", "_item"), F.col("item_id").eqNullSafe(F.col("_item"))
    )
    verified = map_rows(
        pairs.select("region", "item_id", "offset", "words", "body"),
        _verify_step,
        "region long, item_id long, n_match int, item_word int, n_words int, at int",
    )
    return regions.select("doc_id", "key", "start", "region").join(verified, "region")


def overlaps(docs: DataFrame, items: DataFrame, id_col="doc_id", item_col="item_id", text_col="text") -> DataFrame:
    """One row per document and benchmark item that overlap.

    ``n_match`` words agree in the best stretch of ``n_words``, which begins at ``doc_word`` of the
    document and ``item_word`` of the item.
    """
    best = F.max(F.struct("n_match", (-F.col("n_words")).alias("m"), (-F.col("w")).alias("w"), (-F.col("item_word")).alias("i")))
    return (
        _overlapping(docs, items, id_col, item_col, text_col)
        .withColumn("w", F.col("start") + F.col("at"))
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.n_match").cast("long").alias("n_match"),
            (-F.col("best.m")).cast("long").alias("n_words"),
            (-F.col("best.w")).cast("long").alias("doc_word"),
            (-F.col("best.i")).cast("long").alias("item_word"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that overlap no benchmark item; rows of one id, or of none, each by its own text."""
    bad = _overlapping(docs, items, "doc_id", "item_id", "text").select("doc_id", "key").distinct()
    # Written first: a short list is broadcast and no text moves; a long one is joined by hash.
    bad = write_table(bad, scratch_path(docs.sparkSession, "contaminated")).toDF("_bad", "_bad_key")
    same = docs["doc_id"].eqNullSafe(bad["_bad"]) & (text_key(docs["text"]) == bad["_bad_key"])
    return docs.join(bad, same, "left_anti")
