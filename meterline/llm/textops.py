"""Helpers the operators share: tables, Arrow text batches and word hashes."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words end at ASCII white space: space and \x09 to \x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: An odd base, its inverse modulo 2^64, and the odd multipliers of shingle positions.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = np.array([pow(0xD1342543DE82EF95, 2 * k + 1, 1 << 64) for k in range(64)], dtype=np.uint64)

#: Bytes hashed at once; a longer text is cut at white space.
CHUNK = 1 << 18

_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def thinned(df: DataFrame, limit: int, *key: str) -> DataFrame:
    """About ``limit`` rows at most (the expected number), those of the lowest key hashes.

    A filter by a rate: no task or driver gathers candidates, however many tasks there are. Rows of
    equal keys stay or go together, so the key should hold the id: copies of a text have many.
    """
    rate = limit / max(limit, df.count())
    u = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df.filter(u < F.lit(rate))


def text_key(text: str | Column) -> Column:
    """A hash of a text; with the id it names a row where ids repeat or are null."""
    return F.xxhash64((F.col(text) if isinstance(text, str) else text).cast("string"))


BATCH_ROWS = 1000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Writes a table of this run and reads it again.

    Rows that carry texts or sets are some kilobytes each, so Arrow batches are kept small while the
    table is written; the session's setting is put back afterwards.
    """
    conf = df.sparkSession.conf
    before = conf.get(_BATCH_KEY, None)
    conf.set(_BATCH_KEY, str(BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(_BATCH_KEY)
        else:
            conf.set(_BATCH_KEY, before)
    return df.sparkSession.read.parquet(path)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def map_rows(df: DataFrame, step: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Runs a generator over each partition's rows, as tuples, in Arrow batches.

    ``step`` sees the partition as one stream of tuples in the order of the columns and yields
    output tuples; at most ``OUT_ROWS`` rows or ``OUT_BYTES`` of strings are held at once.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    parsed = _parse_datatype_string(schema)
    arrow = to_arrow_schema(parsed)

    owner = step.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _make_room(owner)

        def stream() -> Iterator[tuple]:
            for batch in batches:
                # Slices keep few Python objects of a batch alive at a time.
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        held: list[tuple] = []
        weight = 0
        for row in step(stream()):
            held.append(row)
            weight += sum(len(x) for x in row if isinstance(x, str | bytes))
            if len(held) >= OUT_ROWS or weight >= OUT_BYTES:
                yield _batch(held, arrow)
                held, weight = [], 0
        if held:
            yield _batch(held, arrow)
        _give_back()

    return df.mapInArrow(run, parsed)


_kept: dict[tuple[str, str], object] = {}


def kept(owner: str, name: str, build: Callable[[], object]):
    """What a worker keeps from task to task (a vocabulary, say), until another module's step runs there.

    Workers live on between stages, and the tables of all stages together would add up in each.
    """
    if (owner, name) not in _kept:
        _kept[owner, name] = build()
    return _kept[owner, name]


def _make_room(owner: str) -> None:
    other = [k for k in _kept if k[0] != owner]
    for k in other:
        del _kept[k]
    if other:
        gc.collect()
        _give_back()


def _give_back() -> None:
    """Returns memory that a task has freed to the system; workers live on and would keep it."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim:
        trim(0)


SLICE = 256
OUT_ROWS = 4096
OUT_BYTES = 1 << 23


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=arrow)


def bit_table(places: DataFrame, bits: int) -> np.ndarray:
    """A table of ``2^bits`` bits with those of the column ``place`` set, as 32-bit words.

    Spark gathers the words, so the driver gets at most ``2^bits / 32`` rows of any input.
    """
    bit = F.expr("shiftleft(1L, cast(place & 31 as int))")
    words = places.groupBy(F.shiftright("place", 5).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def _hash_chunk(data: np.ndarray) -> np.ndarray:
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1])
    if not len(edge):
        return np.empty(0, dtype=np.uint64)
    start, end = edge[::2], edge[1::2]
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(up[: len(data)] * (data + np.uint64(1)), out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased.

    A prefix sum of a polynomial gives all words of a chunk at once.
    """
    if not text:
        return np.empty(0, dtype=np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    if len(data) <= CHUNK:
        return _hash_chunk(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data):
            gap = np.flatnonzero(_SPACE[data[end : end + 4096]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 4096, len(data))
        parts.append(_hash_chunk(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, width)
    count = n - size + 1
    out = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        out += words[k : k + count] * _PLACE[k]
    return mix(out)
