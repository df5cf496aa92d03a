"""Vector code compression: four codebooks of 256 entries, learned with norm-of-sum bounds.

Vectors become integers and are cut into four parts; each part's codebook is refined by rounds of
nearest-entry assignment and integer means. Everything decided is decided in exact integers. Distances
that cannot matter are not computed: per vector and part the state holds a bound on the distance
to the own entry and, for each block of near entries, one on the distance to the nearest of them.
Bounds are not adjusted round by round. Each carries the round it was made in, and the codebooks of all rounds are kept,
so in a later round it is loosened by how far the entries truly moved since (the norm of the summed
moves), which is never more than the sum of the moves' norms. Where own and block bounds meet, the own distance is
computed exactly, and blocks that are still in reach are scanned again.

A round is one pass over a written table: tasks assign, write the new state, and add their vectors up
by entry. Spark adds the tasks' sums; the driver gets the next codebooks, whose size is fixed by entries
and dimension. A lost executor repeats part of one round.

Defined cases: rows are left out whose vector is null, has null or non-finite components, or has another
number of components than that of the least kept id. Components beyond +-2^16 count as +-2^16 times 1024, so that
squares stay exact. Vectors whose length isn't a multiple of four count as filled up with zeros. Rows
that repeat an id are coded each; the codebook starts with that of the least vector. A null id is coded,
but starts no entry. With fewer ids than entries the codebook is smaller, and without any id rows have no
code and error. A sum of errors past the range of a long is null. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path
from .textops import write_table

#: Entries per codebook, parts of a vector, rounds, scale of components (by the query's contract).
ENTRIES = 256
PARTS = 4
ROUNDS = 4
SCALE = 1024
#: Components beyond count as this; integers then square exactly in a long.
MOST = 1 << 16
#: Entries that share a bound, on average. Vectors handled at once.
BLOCK = 16
CHUNK = 2048
#: Integers up to this have exact squared distances in doubles, for 512 components or fewer a part.
EXACT = 1 << 21

_STATE = (
    "vec_id long, label long, ints binary, code binary, own binary, own_round binary, "
    "near binary, near_round binary, error long, cell int, sums array<long>, n long"
)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries, as integers."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT and x.shape[1] <= 512:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in c], axis=1) if len(c) else np.empty((len(x), 0), np.int64)


def own_distances(x: np.ndarray, c: np.ndarray, code: np.ndarray) -> np.ndarray:
    return ((x - c[code]) ** 2).sum(1)


def _up(d2: np.ndarray) -> np.ndarray:
    """Distances of squared ones, rounded up to the next 32-bit float."""
    return np.nextafter(np.sqrt(d2.astype(np.float64)).astype(np.float32), np.float32(np.inf))


def _down(d2: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(d2.astype(np.float64)).astype(np.float32), np.float32(-np.inf))


def blocks_of(book: np.ndarray) -> list[np.ndarray]:
    """Entries of one codebook in blocks of near ones, ``BLOCK`` to a block on average; a block may be empty.

    Each entry goes to the nearest of some entries that lie far apart.
    """
    d2 = distances(book, book)
    far = [0]
    while len(far) < -(-len(book) // BLOCK):
        far.append(int(d2[far].min(0).argmax()))
    nearest = d2[far].argmin(0)
    return [np.flatnonzero(nearest == k) for k in range(len(far))]


class Moves:
    """The blocks of the first codebooks, and how far entries moved from each round to the newest.

    ``entry`` has each entry's move and ``block`` that of each block's farthest, by round and part.
    """

    def __init__(self, history: list[np.ndarray]):
        now = history[-1]
        self.blocks = [blocks_of(book) for book in history[0]]
        self.home = np.zeros(now.shape[:2], np.int64)
        # An entry at its old place moved by 0, where _up would give the least number above 0.
        far = [np.where((now == old).all(2), np.float32(0), _up(((now - old) ** 2).sum(2))) for old in history]
        self.entry = np.stack(far)
        self.block = np.zeros((len(history), PARTS, len(self.blocks[0])), np.float32)
        for p, blocks in enumerate(self.blocks):
            for b, entries in enumerate(blocks):
                self.home[p, entries] = b
                self.block[:, p, b] = self.entry[:, p, entries].max(1, initial=0)


class State:
    """Codes and stamped bounds of a batch of vectors; arrays by (row, part) or (row, part, block)."""

    def __init__(self, ints: np.ndarray, n_entries: int):
        n, blocks = len(ints), -(-n_entries // BLOCK)
        self.ints = ints
        self.code = np.zeros((n, PARTS), np.uint8)
        self.own = np.full((n, PARTS), np.inf, np.float32)
        self.own_round = np.zeros((n, PARTS), np.uint8)
        self.near = np.zeros((n, PARTS, blocks), np.float32)
        self.near_round = np.zeros((n, PARTS, blocks), np.uint8)
        self.scanned = 0

    def assign(self, history: list[np.ndarray], moves: Moves, first: bool) -> None:
        """Nearest entries of the newest codebooks; ties go to the lower index."""
        now, book = len(history) - 1, history[-1]
        for p in range(PARTS):
            x = self.ints[:, p].astype(np.int64)
            if first:
                self._scan_all(p, x, book[p], moves.blocks[p])
                continue
            code, every = self.code[:, p].astype(np.int64), np.arange(self.near.shape[2])
            own_move = moves.entry[self.own_round[:, p], p, code]
            near_move = moves.block[self.near_round[:, p], p, every[None, :]]
            # Rounded away from each other, so that bounds in 32 bits stay bounds.
            own = np.nextafter(self.own[:, p] + own_move, np.float32(np.inf))
            near = np.nextafter(self.near[:, p] - near_move, np.float32(-np.inf))
            self._rescan(p, x, book[p], moves.blocks[p], moves.home[p], code, own, near, now)

    def _scan_all(self, p: int, x: np.ndarray, book: np.ndarray, blocks: list[np.ndarray]) -> None:
        d2 = distances(x, book)
        self.scanned += d2.size
        code = d2.argmin(1)
        rows = np.arange(len(x))
        self.code[:, p], self.own[:, p] = code, _up(d2[rows, code])
        d2[rows, code] = np.iinfo(np.int64).max
        for b, entries in enumerate(blocks):
            self.near[:, p, b] = _down(d2[:, entries].min(1, initial=np.iinfo(np.int64).max))

    def _rescan(self, p, x, book, blocks, home, code, own, near, now) -> None:
        """Tightens own distances where a block is in reach, then scans the blocks that still are."""
        doubtful = np.flatnonzero((near <= own[:, None]).any(1))
        if not len(doubtful):
            return
        d_own = own_distances(x[doubtful], book, code[doubtful])
        self.own[doubtful, p], self.own_round[doubtful, p] = _up(d_own), now
        reach = near[doubtful] <= self.own[doubtful, p][:, None]
        best, best_code = d_own.copy(), code[doubtful].copy()
        found = {}
        for b in np.flatnonzero(reach.any(0)):
            at = np.flatnonzero(reach[:, b])
            d2 = distances(x[doubtful[at]], book[blocks[b]])
            self.scanned += d2.size
            found[b] = at, d2
            entry = d2.argmin(1)  # the lower index of equals, as blocks are in order
            d, j = d2[np.arange(len(at)), entry], blocks[b][entry]
            better = (d < best[at]) | ((d == best[at]) & (j < best_code[at]))
            best[at[better]], best_code[at[better]] = d[better], j[better]
        # An entry left for another becomes one of its block's, at the distance just computed.
        moved = np.flatnonzero(best_code != code[doubtful])
        rows, block = doubtful[moved], home[code[doubtful[moved]]]
        self.near[rows, p, block] = np.minimum(near[rows, block], _down(d_own[moved]))
        self.near_round[rows, p, block] = now
        self.code[doubtful, p] = best_code
        self.own[doubtful, p] = _up(best)
        for b, (at, d2) in found.items():
            inside = np.flatnonzero(home[best_code[at]] == b)
            d2[inside, np.searchsorted(blocks[b], best_code[at[inside]])] = np.iinfo(np.int64).max
            self.near[doubtful[at], p, b] = _down(d2.min(1))
            self.near_round[doubtful[at], p, b] = now

    def errors(self, book: np.ndarray) -> np.ndarray:
        return sum(own_distances(self.ints[:, p].astype(np.int64), book[p], self.code[:, p].astype(np.int64)) for p in range(PARTS))

    def columns(self) -> list[pa.Array]:
        held = (self.ints, self.code, self.own, self.own_round, self.near, self.near_round)
        return [pa.array([row.tobytes() for row in a], pa.binary()) for a in held]

    @classmethod
    def of(cls, columns: list[list[bytes]], n_entries: int, width: int) -> State:
        out = cls(np.frombuffer(b"".join(columns[0]), np.int32).reshape(len(columns[0]), PARTS, width), n_entries)
        for name, data in zip(("code", "own", "own_round", "near", "near_round"), columns[1:], strict=True):
            like = getattr(out, name)
            setattr(out, name, np.frombuffer(b"".join(data), like.dtype).reshape(like.shape).copy())
        return out


def _pass(history: list[np.ndarray], first: bool, last: bool):
    """The step of one round over Arrow batches: new state rows, then the task's sums by entry."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_STATE))
    n_entries, width = history[-1].shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = Moves(history)
        sums = np.zeros((PARTS, n_entries, width), np.int64)
        count = np.zeros((PARTS, n_entries), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                n = part.num_rows
                if first:
                    ints = part.column("ints").flatten().to_numpy(zero_copy_only=False)
                    state = State(ints.astype(np.int32).reshape(n, PARTS, width), n_entries)
                else:
                    names = ("ints", "code", "own", "own_round", "near", "near_round")
                    state = State.of([part.column(c).to_pylist() for c in names], n_entries, width)
                state.assign(history, moves, first)
                for p in range(PARTS):
                    code = state.code[:, p]
                    np.add.at(sums[p], code, state.ints[:, p])
                    count[p] += np.bincount(code, minlength=n_entries)
                error = pa.array(state.errors(history[-1])) if last else pa.nulls(n, pa.int64())
                held = state.columns()
                if last:  # nothing reads vectors and bounds after the last round
                    held = [pa.nulls(n, pa.binary()), held[1], *[pa.nulls(n, pa.binary())] * 4]
                rest = [pa.nulls(n, f.type) for f in list(schema)[-3:]]
                own = [part.column("vec_id"), part.column("label")]
                yield pa.RecordBatch.from_arrays([*own, *held, error, *rest], schema=schema)
        cells = np.flatnonzero(count.ravel())
        if len(cells) and not last:
            n = len(cells)
            columns = [pa.nulls(n, f.type) for f in list(schema)[:-3]]
            flat = sums.reshape(PARTS * n_entries, width)[cells]  # width may be 0
            columns += [pa.array(cells, pa.int32()), pa.array(list(flat), pa.list_(pa.int64())), pa.array(count.ravel()[cells])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def kept_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, label, ints): rows with a whole, finite vector, its components as integers."""
    x = F.col(column)
    sound = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    scaled = F.transform(x, lambda v: F.floor(F.greatest(F.least(v.cast("double"), F.lit(float(MOST))), F.lit(-float(MOST))) * SCALE).cast("int"))
    fill = F.expr(f"array_repeat(0, int(pmod(-size({column}), {PARTS})))")
    return vectors.filter(sound).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long").alias("label"), F.concat(scaled, fill).alias("ints"),
        F.size(x).alias("_size"),
    )


def start(vectors: DataFrame, entries: int = ENTRIES) -> tuple[np.ndarray, int] | None:
    """The vectors of the least ids as first codebooks, and the number of components kept; None without any."""
    ids = vectors.filter("vec_id is not null").select("vec_id").distinct().orderBy("vec_id")
    least = ids.limit(1).join(vectors, "vec_id").agg(F.min(F.struct("ints", "_size")).alias("v")).first()["v"]
    if least is None:
        return None
    same = vectors.filter(F.col("_size") == least["_size"])
    ids = same.filter("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries)
    found = same.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.min("ints").alias("ints")).collect()  # at most ``entries``
    rows = np.array([r["ints"] for r in sorted(found, key=lambda r: r["vec_id"])], np.int64)
    return rows.reshape(len(rows), PARTS, -1).transpose(1, 0, 2), least["_size"]


def _means(book: np.ndarray, state: DataFrame) -> np.ndarray:
    """The next codebooks: floor of sum by count, unused entries as they were."""
    cells = state.filter("cell is not null").select("cell", "n", F.posexplode("sums").alias("pos", "s"))
    added = cells.groupBy("cell", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    got = added.toArrow()  # at most a row per number of the codebooks
    out = book.copy().reshape(book.shape[0] * book.shape[1], book.shape[2])
    s, n = got["s"].to_numpy(), got["n"].to_numpy()
    out[got["cell"].to_numpy(), got["pos"].to_numpy()] = s // n
    return out.reshape(book.shape)


def books_text(book: np.ndarray) -> str:
    return ",".join(str(v) for v in book.ravel())


def learn(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, list[np.ndarray]]:
    """Coded rows (vec_id, label, code, error) and the codebooks of all rounds, by part, entry and position."""
    spark = vectors.sparkSession
    begin = start(vectors, entries)
    if begin is None:
        none = vectors.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return none, []
    book, size = begin
    history, state, path = [book], vectors.filter(F.col("_size") == size).select("vec_id", "label", "ints"), None
    for round_no in range(rounds + 1):
        new = scratch_path(spark, "codes")
        step = _pass(history, round_no == 0, round_no == rounds)
        state.mapInArrow(step, _STATE).write.parquet(new)
        old, path, state = path, new, spark.read.parquet(new)
        if old:
            drop_path(spark, old)
        if round_no < rounds:
            history.append(_means(history[-1], state))
            state = state.filter("cell is null")
    return state.filter("cell is null").select("vec_id", "label", "code", "error"), history


def encode(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Per kept row: vec_id, code, error, label_error and the digest of the final codebooks."""
    coded, history = learn(kept_vectors(vectors, column))
    digest = hashlib.sha256(books_text(history[-1]).encode()).hexdigest() if history else None
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    # Written, so that its size is known: few labels are broadcast; of many, adaptive planning splits a hot one's rows.
    sums = write_table(sums, scratch_path(coded.sparkSession, "label-errors"))
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"])).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
