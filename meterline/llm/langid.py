"""Language identification by bit-sliced Bloom filters over character n-grams.

Each language has a set of frequent n-grams: four letters, shorter at a word's end, with the letter
before. One Bloom filter holds them all, sliced by language: row ``p`` has a bit for every language
whose filter sets position ``p``. The AND of an n-gram's rows is the mask of all languages that
(seem to) contain it. Over a document the masks give a count per language; false positives, known
from each slice's fill, are taken off, and the largest corrected share decides.

Training counts the n-grams of a bounded sample of labelled documents: about ``PER_LANGUAGE`` of each
language, those whose hash is lowest. An n-gram belongs to a language if it makes up at least
``1 / GRAMS`` of its n-grams there, so no set has more than ``GRAMS`` members, whatever the corpus.

Defined cases: null texts and texts without letters are ``und`` with score 0. Equal shares go to the
first language in order. A text with letters but no known n-gram gets the first language and score 0.
Without labelled documents every text is ``und``. Repeated rows are each returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import map_rows, mix

#: Labelled documents used per language (expected number) and n-grams kept per language at most.
PER_LANGUAGE = 3000
GRAMS = 20_000
#: Filter positions and positions set per n-gram.
BITS = 18
PROBES = 3
CHUNK = 1 << 20
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of a text's n-grams, one array per chunk."""
    if not text:
        return
    low = text.lower()
    letter = _is_letter()
    for at in range(0, len(low), CHUNK):
        part = low[max(0, at - 1) : at + CHUNK + 2]
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lead = 0 if at else 1
        body = min(CHUNK, len(low) - at)
        c = np.zeros(body + 3, dtype=np.uint64)
        own = np.where(letter[code], code, 0)
        c[lead : lead + len(own)] = own
        first, centre, third, fourth = c[:body], c[1 : body + 1], c[2 : body + 2], c[3:]
        tail = third + (np.where(third > 0, fourth, 0).astype(np.uint64) << np.uint64(21))
        key = mix(first + (centre << np.uint64(21)) + mix(tail))
        yield key[centre > 0]


@dataclass
class Model:
    languages: list[str]
    rows: np.ndarray  # (2^BITS, bytes): a bit for each language
    false_rate: np.ndarray

    @classmethod
    def of(cls, sets: dict[str, np.ndarray]) -> Model:
        languages = sorted(sets)
        rows = np.zeros((1 << BITS, max(1, -(-len(languages) // 8))), dtype=np.uint8)
        rate = np.zeros(len(languages))
        for i, name in enumerate(languages):
            for place in places(sets[name]):
                rows[place, i // 8] |= np.uint8(0x80 >> i % 8)
            fill = (rows[:, i // 8] & np.uint8(0x80 >> i % 8) > 0).mean()
            rate[i] = fill**PROBES
        return cls(languages, rows, rate)

    def predict(self, text: str | None) -> tuple[str, float]:
        total = 0
        hits = np.zeros(len(self.languages))
        for own in grams(text):
            total += len(own)
            if not len(own):
                continue
            first, *rest = places(own)
            mask = self.rows[first]
            for place in rest:
                mask = mask & self.rows[place]
            hits += np.unpackbits(mask, axis=1).sum(axis=0, dtype=np.int64)[: len(hits)]
        if not total or not len(hits):
            return UNKNOWN, 0.0
        share = np.clip((hits / total - self.false_rate) / (1 - self.false_rate), 0.0, 1.0)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def places(own: np.ndarray) -> list[np.ndarray]:
    low = np.uint64((1 << BITS) - 1)
    return [((own >> np.uint64(20 * k)) & low).astype(np.int64) for k in range(PROBES)]


def _count_step(limit: int = 1 << 21):
    def counted(held: dict[str, list[np.ndarray]]) -> Iterator[tuple]:
        for lang, parts in held.items():
            value, count = np.unique(np.concatenate(parts), return_counts=True)
            for v, n in zip(value.view(np.int64).tolist(), count.tolist(), strict=True):
                yield lang, v, n

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for lang, text in rows:
            for own in grams(text):
                held.setdefault(lang, []).append(own)
                size += len(own)
            if size >= limit:
                yield from counted(held)
                held, size = {}, 0
        yield from counted(held)

    return step


def fit(
    labelled: DataFrame, per_language: int = PER_LANGUAGE, id_col="doc_id", text_col="text", lang_col="lang"
) -> Model:
    """Learns from the rows with a text and a language; the id only spreads copies in the sample."""
    own = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    own = own.filter("lang is not null and text is not null")
    size = own.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("rate"))
    u = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = own.join(F.broadcast(size), "lang").filter(u < F.col("rate")).select("lang", "text")  # a row per language
    found = map_rows(some, _count_step(), "lang string, gram long, n long")
    total = found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = total.withColumn("share", F.expr("n / sum(n) over (partition by lang)"))
    kept = total.filter((F.col("share") >= 1.0 / GRAMS) & (F.col("n") > 1)).select("lang", "gram").toArrow()
    names = np.array(kept["lang"].to_pylist(), dtype=object)
    value = kept["gram"].to_numpy().view(np.uint64)
    known = {r["lang"] for r in size.select("lang").collect()}
    return Model.of({n: value[names == n] if len(names) else value for n in known})


def _predict_step(model):
    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = model.value
        for doc_id, text in rows:
            yield doc_id, *own.predict(text)

    return step


def predict(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, by its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return map_rows(own, _predict_step(shared), "doc_id long, lang_pred string, score double")
