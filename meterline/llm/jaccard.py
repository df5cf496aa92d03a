"""N-gram Jaccard join: documents whose sets of word shingles are similar, and their components.

Exact for any data: two documents link when ``100 * intersection >= percent * union``.

1. A scan hashes each document's set of shingles. Documents of equal sets form a class; only
   classes go on, so copies cost one row each. Later scans hash the texts again instead of writing
   all sets out, which would take twice the size of the input; pairs are verified on compressed texts.
2. *Hubs.* Classes that share minima of their hashed sets are compared with one class of those
   minima, the one with the fewest rare shingles (of edited copies, the one edited least). Those
   found similar join that hub's group, at a known distance (length and suffix filter go first). Large groups of near copies become
   stars here: linear, never all pairs.
3. *Prefix join between groups.* Shingles are ordered rare first, by a sketch of fixed size of
   document frequencies, counted over all documents (any total order gives the same result). Similar sets share a shingle
   among their first ``n - ceil(t n) + 1``. Prefix shingles are joined on their hash; a token's rows
   of one group are combined first, so pairs within a group are never made. The length and
   positional filters are part of the join, the suffix filter (counts of the sets in fixed hash
   ranges bound their distance from below) follows, and each pair is verified once.
4. *Between members.* Jaccard distance is a metric: members x, y of hubs g, h can link only if
   ``d(x,g) + d(y,h) >= d(g,h) - (1 - t)``. Groups whose hubs don't link but come that near are
   compared further: first members with the other hub, then the members that are left.

Components come from links between classes by alternating large and small stars.

Defined cases: null or empty text and texts of white space only have an empty set and link with
nothing, also not with each other. Repeated rows are each returned; rows of one id but different
texts are separate texts whose components both count for that id. Columns other than the id and
the text are ignored, whatever their names. Null ids take part and get a component; a component of
null ids only has a null ``component_id``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path
from .textops import bit_table, map_rows, mix, shingles, text_key, word_hashes, write_table

#: Words per shingle and the least similarity in percent.
WIDTH = 5
PERCENT = 80
#: Minimum hashes per class in the search for hubs.
MINIMA = 6
#: Counters of the sketch of document frequencies (its broadcast takes four bytes each).
SKETCH_BITS = 20
#: Shingles gathered by a task before their repeats are counted, cells in a row of a task's sketch, and
#: documents beyond twice the mean from which a cell counts as frequent.
SKETCH_BLOCK = 1 << 20
SKETCH_PART = 1 << 10
LEAST_SEEN = 8
#: Bits of the filter that says whose sets a scan returns (2 MB).
WANTED_BITS = 24
#: Pairs of one class that are verified by one task, about.
SHARE = 4096
#: Hash ranges of the suffix filter.
RANGES = 64
#: Compression level of texts on their way to a verification, and shingles of sets a task keeps there.
PACK_LEVEL = 3
HELD_SHINGLES = 1 << 19

_SEEDS = mix(np.arange(1, MINIMA + 3, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
EMPTY_CLASS = 0


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    every = np.sort(shingles(word_hashes(text), width))
    if len(every) < 2:
        return every
    new = np.ones(len(every), dtype=bool)
    np.not_equal(every[1:], every[:-1], out=new[1:])
    return every if new.all() else every[new]


def class_id(own: np.ndarray) -> int:
    """Names a set by a 64-bit hash of its members; 0 is the empty set."""
    if not len(own):
        return EMPTY_CLASS
    total = mix(own ^ _SEEDS[0]).sum(dtype=np.uint64)
    h = mix(np.array([total ^ np.uint64(len(own))], dtype=np.uint64))
    return int(h.view(np.int64)[0]) or 1


def _signed(h: np.ndarray) -> list[int]:
    return h.view(np.int64).tolist()


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` of which a similar set must share one."""
    return n - -(-percent * n // 100) + 1


def _scan_step(width: int, sketch_bits: int, block: int):
    """Rows of the first scan: kind 0 per document, kind 1 per part of the task's sketch.

    The sketch has two counters per cell: documents that hold one of its shingles, and those of them
    whose shingle another document of the same block holds too.
    """

    def add(held: list[np.ndarray], seen: np.ndarray, again: np.ndarray) -> None:
        every = np.sort(np.concatenate(held))
        first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        count = np.diff(np.r_[first, len(every)]).astype(np.int32)
        cell = (every[first] >> np.uint64(64 - sketch_bits)).astype(np.int64)
        np.add.at(seen, cell, count)
        often = count > 1
        np.add.at(again, cell[often], count[often])

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        seen, again = np.zeros((2, 1 << sketch_bits), dtype=np.int32)
        held, size = [], 0
        for doc_id, key, text in rows:
            own = shingle_set(text, width)
            yield 0, doc_id, class_id(own), len(own), key, None, None, None
            if len(own):
                held.append(own)
                size += len(own)
            if size >= block:
                add(held, seen, again)
                held, size = [], 0
        if held:
            add(held, seen, again)
        cells = np.flatnonzero(seen)
        for at in range(0, len(cells), SKETCH_PART):
            part = cells[at : at + SKETCH_PART]
            yield 1, None, None, None, None, part.tolist(), seen[part].tolist(), again[part].tolist()

    return step


def _place(column: str):
    """Place of an id in the filter of wanted documents; null ids share one."""
    return F.xxhash64(column).bitwiseAND(F.lit((1 << WANTED_BITS) - 1)).alias("place")


def _sets_step(width: int, wanted):
    """Rows of a later scan: class and packed text of the documents whose id the filter may hold.

    A packed text takes a third of its set's bytes or less, as hashes don't compress; the set is
    made again from it where a pair is verified.
    """

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        bits = wanted.value
        for place, text in rows:
            if int(bits[place >> 5]) >> (place & 31) & 1:
                own = shingle_set(text, width)
                if len(own):
                    words = text.encode("utf-8", "surrogatepass").lower()
                    yield class_id(own), zstandard.compress(words, PACK_LEVEL)

    return step


def _class_step(width: int, percent: int, sketch):
    """Rows of the second scan: a class's size, prefix shingles rare first, minima, counts by range
    and number of shingles that are not frequent."""

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        weight = sketch.value
        shift = np.uint64(64 - (len(weight).bit_length() - 1))
        for doc_id, text in rows:
            own = shingle_set(text, width)
            n = len(own)
            if not n:
                continue
            heavy = weight[(own >> shift).astype(np.int64)]
            # own is sorted by hash, so a stable sort by weight breaks ties by hash.
            order = np.argsort(heavy, kind="stable")
            prefix = own[order[: prefix_length(n, percent)]].tobytes()
            least = np.array([(own * s).min() for s in _SEEDS[2:]], dtype=np.uint64)
            counts = np.bincount((own >> np.uint64(58)).astype(np.int64), minlength=RANGES)
            rare = n - int(np.count_nonzero(heavy))
            yield class_id(own), doc_id, n, prefix, _signed(least), counts.tolist(), rare

    return step


def _combine_step(block: int = 1 << 16):
    """Explodes prefixes and combines the rows of one token and hub that a task holds.

    ``rest`` is the largest number of shingles from the token's place on, which bounds what two
    sets can share from there.
    """

    def combined(held: list[tuple]) -> Iterator[tuple]:
        token = np.concatenate([t for t, *_ in held])
        sizes = [len(t) for t, *_ in held]
        hub = np.repeat(np.array([h for _, h, _ in held], dtype=np.int64), sizes)
        n = np.repeat(np.array([n for *_, n in held], dtype=np.int64), sizes)
        rest = n - np.concatenate([np.arange(s) for s in sizes])
        order = np.lexsort((hub, token))
        token, hub, n, rest = token[order], hub[order], n[order], rest[order]
        at = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (hub[1:] != hub[:-1])])
        yield from zip(
            token[at].tolist(),
            hub[at].tolist(),
            np.minimum.reduceat(n, at).tolist(),
            np.maximum.reduceat(n, at).tolist(),
            np.maximum.reduceat(rest, at).tolist(),
            strict=True,
        )

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        held, size = [], 0
        for hub, n, prefix in rows:
            token = np.frombuffer(prefix, dtype=np.int64)
            held.append((token, hub, n))
            size += len(token)
            if size >= block:
                yield from combined(held)
                held, size = [], 0
        if held:
            yield from combined(held)

    return step


def _verify_step(width: int):
    """Counts what two sets share. Sets made again are kept for the next pairs, a few megabytes."""

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[bytes, np.ndarray] = {}
        size = 0
        for a, b, *packed in rows:
            sets = []
            for one in packed:
                own = held.get(one)
                if own is None:
                    own = shingle_set(zstandard.decompress(one).decode("utf-8", "surrogatepass"), width)
                    if size + len(own) > HELD_SHINGLES:
                        held, size = {}, 0
                    held[one] = own
                    size += len(own)
                sets.append(own)
            x, y = sets
            place = np.searchsorted(x, y)
            place[place == len(x)] = 0
            yield a, b, len(x), len(y), int((x[place] == y).sum())

    return step


class JaccardJoin:
    """One run over a table of documents; tables it writes go to the shared scratch folder."""

    def __init__(self, docs: DataFrame, id_col="doc_id", text_col="text", width=WIDTH, percent=PERCENT):
        self.spark: SparkSession = docs.sparkSession
        self.docs = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
        )
        # Rows are told apart by id and text.
        self.keyed = self.docs.select("doc_id", text_key("text").alias("key"), "text")
        self.width, self.percent = width, percent
        self.far = 1.0 - percent / 100.0
        self._written: list[str] = []

    # ---- tables -------------------------------------------------------------------------

    def _save(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, f"jaccard-{label}")
        self._written.append(path)
        return write_table(df, path)

    def _similar(self, shared, a, b):
        """Whether sets of sizes ``a`` and ``b`` with ``shared`` common members link."""
        return 100 * shared >= self.percent * (a + b - shared)

    def _scan(self) -> None:
        schema = "kind int, id long, cls long, n long, key long, cell array<int>, seen array<int>, again array<int>"
        both = self._save(map_rows(self.keyed, _scan_step(self.width, SKETCH_BITS, SKETCH_BLOCK), schema), "scan")
        self.members = both.filter("kind = 0").select(F.col("id").alias("doc_id"), "key", "cls", "n")
        # Frequent: repeated within a block, or in a cell of more than twice the mean over all documents.
        usual = 2 * (self.members.agg(F.sum("n")).first()[0] or 0) // (1 << SKETCH_BITS) + LEAST_SEEN
        cells = (
            both.filter("kind = 1")
            .select(F.inline(F.arrays_zip("cell", "seen", "again")))
            .groupBy("cell")
            .agg(F.sum("seen").alias("seen"), F.sum("again").alias("again"))
            .select("cell", F.greatest("again", F.col("seen") - usual).alias("n"))
            .filter("n > 0")
            .toArrow()
        )
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        sketch[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        self.sketch = self.spark.sparkContext.broadcast(np.minimum(sketch, 1 << 30).astype(np.int32))
        step = _class_step(self.width, self.percent, self.sketch)
        schema = "cls long, id long, n long, prefix binary, least array<long>, counts array<int>, rare long"
        rows = map_rows(self.docs, step, schema)
        # Rows of a class are alike; later scans take its set from the document of its smallest id.
        first = [F.first(c).alias(c) for c in ("n", "prefix", "least", "counts", "rare")]
        self.classes = self._save(rows.groupBy("cls").agg(F.min("id").alias("rep"), *first), "classes")

    def _sets(self, names: DataFrame) -> DataFrame:
        """Packed text of each class named in ``cls``, that of one document of the class.

        A filter of fixed size on that document's id spares the other documents' rows and most of
        the work on them. It may let other classes through; the join with the pairs drops those.
        """
        ids = names.join(self.classes.select("cls", "rep"), "cls")
        wanted = self.spark.sparkContext.broadcast(bit_table(ids.select(_place("rep")), WANTED_BITS))
        rows = self.docs.select(_place("doc_id"), "text")
        scan = map_rows(rows, _sets_step(self.width, wanted), "cls long, members binary")
        return scan.groupBy("cls").agg(F.first("members").alias("members"))

    def _verify(self, pairs: DataFrame, label: str) -> DataFrame:
        """Sizes and shared shingles of each pair ``a``, ``b`` of classes, and its distance.

        The class with more pairs (a hub, say) is joined first, its pairs in parts of about
        ``SHARE``; so no key is hot there. The other one then has at most as many pairs as the root
        of twice their number. Rows that hold texts are merged, never broadcast.
        """
        degree = pairs.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("k"))
        degree = self._save(degree, f"{label}-degree")
        of = lambda c: degree.select(F.col("cls").alias(c), F.col("k").alias(f"k{c}"))
        first = F.col("ka") >= F.col("kb")
        sided = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b").select(
            "a",
            "b",
            F.when(first, F.col("a")).otherwise(F.col("b")).alias("many"),
            F.when(first, F.col("b")).otherwise(F.col("a")).alias("few"),
            F.ceil(F.greatest("ka", "kb") / SHARE).alias("parts"),
        )
        sided = self._save(sided.withColumn("part", F.expr("pmod(xxhash64(few), parts)")), f"{label}-sided")
        # Both joins read one shuffle of the sets: the plan holds the same exchange twice.
        sets = self._sets(degree.select("cls"))
        cut = sided.select(F.col("many").alias("cls"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"))
        left = sets.join(cut.distinct(), "cls").select(F.col("cls").alias("many"), "part", F.col("members").alias("x"))
        right = sets.select(F.col("cls").alias("few"), F.col("members").alias("y"))
        joined = sided.drop("parts").join(left.hint("merge"), ["many", "part"]).join(right.hint("merge"), "few")
        joined = joined.select("a", "b", "x", "y")
        found = map_rows(joined, _verify_step(self.width), "a long, b long, na long, nb long, shared long")
        shared, na, nb = F.col("shared"), F.col("na"), F.col("nb")
        return self._save(
            found.select(
                "a",
                "b",
                (1.0 - shared / (na + nb - shared)).alias("d"),
                self._similar(shared, na, nb).alias("linked"),
            ),
            label,
        )

    # ---- steps --------------------------------------------------------------------------

    def _hubs(self) -> DataFrame:
        """Star links (a: hub, b: class, d)."""
        least = self.classes.select("cls", "rare", F.posexplode("least").alias("k", "value"))
        # The hub of a minimum is its class of the fewest rare shingles: of copies with edits, that
        # with the fewest. The one that most minima name is a class's candidate.
        hub = least.groupBy("k", "value").agg(F.min(F.struct("rare", "cls")).alias("hub"), F.count("*").alias("size"))
        tried = (
            least.select("cls", "k", "value")
            .join(hub.filter("size > 1").select("k", "value", "hub"), ["k", "value"])
            .groupBy("cls", "hub")
            .agg(F.count("*").alias("votes"))
            .groupBy("cls")
            .agg(F.min(F.struct((-F.col("votes")).alias("votes"), "hub")).alias("best"))
            .select(F.col("best.hub.cls").alias("a"), F.col("cls").alias("b"))
            .filter("a <> b")
        )
        # Many classes share a minimum (that of a common passage) and little else.
        near = self._with_class(self._with_class(tried, "a", "x"), "b", "y").filter(self._can_link("x", "y"))
        pairs = self._save(near.select("a", "b"), "tried")
        return self._verify(pairs, "stars").filter("linked").select("a", "b", "d")

    def _between(self, stars: DataFrame) -> DataFrame:
        """Candidate pairs of hubs, each once."""
        prefix = self.classes.select("cls", "n", "prefix")
        grouped = prefix.join(stars.select(F.col("b").alias("cls"), F.col("a").alias("hub")), "cls", "left")
        rows = map_rows(
            grouped.select(F.coalesce("hub", "cls").alias("hub"), "n", "prefix"),
            _combine_step(),
            "token long, hub long, low long, high long, rest long",
        )
        token = (
            rows.repartition("token")
            .groupBy("token", "hub")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("rest").alias("rest"))
        )
        # Most tokens are in one group only: they go before the join.
        token = self._save(
            token.withColumn("ends", F.expr("min(hub) over (partition by token) < max(hub) over (partition by token)"))
            .filter("ends")
            .drop("ends"),
            "tokens",
        )
        a, b = token.alias("x"), token.alias("y")
        p = self.percent
        length = F.expr(f"100 * x.high >= {p} * y.low and 100 * y.high >= {p} * x.low")
        # Shared at most the smaller rest; needed at least p / (100 + p) of both sizes.
        place = F.expr(f"(100 + {p}) * least(x.rest, y.rest) >= {p} * (x.low + y.low)")
        pairs = a.join(b, F.expr("x.token = y.token and x.hub < y.hub") & length & place)
        return pairs.select(F.col("x.hub").alias("a"), F.col("y.hub").alias("b")).distinct()

    def _can_link(self, x: str, y: str):
        """The length and suffix filters on two structs with ``n`` and ``counts``.

        What the counts differ by in all ranges is not shared, so shared <= (total - apart) / 2.
        """
        apart = F.expr(f"aggregate(zip_with({x}.counts, {y}.counts, (p, q) -> abs(p - q)), 0, (s, p) -> s + p)")
        na, nb = F.col(f"{x}.n"), F.col(f"{y}.n")
        return self._similar(F.least(na, nb), na, nb) & self._similar((na + nb - apart) / 2, na, nb)

    def _with_class(self, df: DataFrame, name: str, out: str) -> DataFrame:
        """Adds size and counts of the class in column ``name`` as a struct."""
        own = self.classes.select(F.col("cls").alias(name), F.struct("n", "counts").alias(out))
        return df.join(own, name)

    def _suffix_filter(self, pairs: DataFrame, radius: DataFrame) -> DataFrame:
        """Drops pairs of single classes that the suffix filter tells apart."""
        full = self._with_class(self._with_class(pairs, "a", "x"), "b", "y")
        for c in ("a", "b"):
            full = full.join(radius.select(F.col("cls").alias(c), F.col("radius").alias(f"r{c}")), c, "left")
        grouped = F.coalesce("ra", F.lit(0.0)) + F.coalesce("rb", F.lit(0.0)) > 0
        return full.filter(self._can_link("x", "y") | grouped).select("a", "b")

    def _members(self, near: DataFrame, stars: DataFrame, radius: DataFrame) -> list[DataFrame]:
        """Links between members of groups whose hubs do not link but are near enough."""
        r = lambda c: radius.select(F.col("cls").alias(c), F.col("radius").alias(f"r{c}"))
        open_ = near.filter("not linked").join(r("a"), "a", "left").join(r("b"), "b", "left")
        open_ = open_.na.fill(0.0, ["ra", "rb"])
        reach = self.far + 1e-9
        open_ = self._save(
            open_.filter((F.col("ra") + F.col("rb") > 0) & (F.col("ra") + F.col("rb") + reach >= F.col("d"))), "open"
        )
        if open_.isEmpty():
            return []
        member = stars.select(F.col("a").alias("hub"), F.col("b").alias("m"), F.col("d").alias("dm"))
        member = self._save(self._with_class(member, "m", "x"), "member")
        # Members with the other hub.
        first = open_.select(F.col("a").alias("hub"), F.col("b").alias("other"), "d").unionByName(
            open_.select(F.col("b").alias("hub"), F.col("a").alias("other"), "d")
        )
        tried = self._with_class(first, "other", "y").join(member, "hub")
        tried = tried.filter((F.col("dm") + reach >= F.col("d")) & self._can_link("x", "y"))
        tried = self._save(tried.select("hub", "other", "m"), "member-hub")
        seen = self._verify(tried.select(F.col("m").alias("a"), F.col("other").alias("b")).distinct(), "member-links")
        linked = seen.filter("linked").select("a", "b")
        # Members with members, of pairs of groups that have no link yet.
        done = tried.join(linked.select(F.col("a").alias("m"), F.col("b").alias("other")), ["m", "other"]).select(
            F.least("hub", "other").alias("a"), F.greatest("hub", "other").alias("b")
        )
        left = open_.filter("ra > 0 and rb > 0").join(done.distinct(), ["a", "b"], "left_anti")
        side = lambda hub, d, c, x: member.select(
            F.col("hub").alias(hub), F.col("m").alias(c), F.col("dm").alias(d), F.col("x").alias(x)
        )
        last = left.join(side("a", "da", "ma", "x"), "a").filter(F.col("da") + F.col("rb") + reach >= F.col("d"))
        last = last.join(side("b", "db", "mb", "y"), "b").filter(
            (F.col("da") + F.col("db") + reach >= F.col("d")) & self._can_link("x", "y")
        )
        last = self._save(last.select(F.col("ma").alias("a"), F.col("mb").alias("b")).distinct(), "member-pairs")
        if last.isEmpty():
            return [linked]
        return [linked, self._verify(last, "last").filter("linked").select("a", "b")]

    def links(self) -> DataFrame:
        """Verified links between classes (a, b), enough to connect each component.

        Links between two members of one hub's group follow from the star and are not listed.
        """
        self._scan()
        stars = self._hubs()
        radius = stars.groupBy(F.col("a").alias("cls")).agg(F.max("d").alias("radius"))
        pairs = self._save(self._suffix_filter(self._between(stars), radius), "pairs")
        near = self._verify(pairs, "near")
        out = stars.select("a", "b").unionByName(near.filter("linked").select("a", "b"))
        for more in self._members(near, stars, radius):
            out = out.unionByName(more)
        return out

    def _named(self) -> DataFrame:
        """Members with words, each with the first row (smallest id, then key) of its component."""
        root = connected(self.links(), lambda df: self._save(df, "star"))
        # Null ids come last, so an id names the component if there is one.
        row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
        first = self.members.filter("n > 0").groupBy("cls").agg(F.min(row).alias("first"))
        rooted = first.join(root.withColumnRenamed("node", "cls"), "cls", "left")
        rooted = rooted.withColumn("root", F.coalesce("root", "cls"))
        least = rooted.groupBy("root").agg(F.min("first").alias("least"))
        labels = rooted.join(least, "root").select("cls", "least")
        return self.members.filter("n > 0").join(labels, "cls")

    def copies(self) -> DataFrame:
        """Id and key of the rows that are not the first of their component."""
        first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("key") == F.col("least.key"))
        return self._named().filter(~first).select("doc_id", "key").distinct()

    def components(self) -> DataFrame:
        """``doc_id, n_shingles, component_id`` per row of the documents."""
        out = self._named().select("doc_id", F.col("n").alias("n_shingles"), F.col("least.doc_id").alias("component_id"))
        alone = self.members.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        return out.unionByName(alone)

    def close(self) -> None:
        """Removes the tables written; call it when the results have been used."""
        for path in self._written:
            drop_path(self.spark, path)
        self._written = []


def connected(links: DataFrame, save) -> DataFrame:
    """Smallest node of each node's component (node, root), by alternating stars."""

    def largest(edges: DataFrame) -> DataFrame:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def smallest(edges: DataFrame) -> DataFrame:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        near = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return near.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()

    edges = save(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        edges = save(smallest(largest(edges)))
        # Exact at the end: every node points at its root and no root points anywhere.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _written(job: JaccardJoin, df: DataFrame, label: str) -> DataFrame:
    """A result as a table of known size; the run's other tables are removed."""
    out = write_table(df, scratch_path(job.spark, f"jaccard-{label}"))
    job.close()
    return out


def components(docs: DataFrame, **options) -> DataFrame:
    job = JaccardJoin(docs, **options)
    return _written(job, job.components(), "components")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One document of each component, that of the smallest id; documents without words all stay.

    Rows that repeat both id and text stay once. A row is named by its id and its text: texts of one
    id are decided on each by itself (the first by hash stays of those in one component), and rows
    without an id stay if their component has no other row before them.
    """
    job = JaccardJoin(docs, **options)
    # Written first: a short list is broadcast and no text moves; a long one is joined by hash.
    copies = _written(job, job.copies(), "copies").toDF("_copy", "_copy_key")
    same = docs["doc_id"].eqNullSafe(copies["_copy"]) & (text_key(docs["text"]) == copies["_copy_key"])
    kept = docs.join(copies, same, "left_anti")
    return kept.dropDuplicates(["doc_id", "text"])
