"""Filter audit, source mixing and vector codes against brute force, on odd rows and hot groups."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from odd import empty_documents, odd_documents
from pyspark.sql import functions as F

from meterline.llm import codebooks, filter_audit, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- filter audit -----------------------------------------------------------------------


def brute_audit(docs, labels):
    """docs: (doc_id, text, lang), labels: (doc_id, quality, toxic)."""
    fails = []
    for i, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        fails.append(
            {
                "part": lang or "",
                "A": len(w) < 200,
                "B": 100 * len(set(w)) < 50 * len(w),
                "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                "D": bool(re.search("[#$%&*|]", t)),
                "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs),
                "good": i is not None and any(j == i and q == 1 for j, q, _ in labels),
                "toxic": i is not None and any(j == i and x == 1 for j, _, x in labels),
            }
        )
    out = {}
    for part in {f["part"] for f in fails}:
        own = [f for f in fails if f["part"] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for s, name in enumerate(order):
                alive = [f for f in own if not any(f[x] for x in order[:s])]
                here = [f for f in alive if f[name]]
                shapley[name] += len(here)
                out[part, "".join(order), s + 1] = [
                    len(alive) - len(here),
                    len(here),
                    sum(f[name] for f in own) - len(here),
                    sum(f[name] and sum(f[x] for x in "ABCDE") == 1 for f in own),
                    sum(f["good"] for f in here),
                    sum(f["toxic"] for f in here),
                ]
        for order in itertools.permutations("ABCDE"):
            for s, name in enumerate(order):
                out[part, "".join(order), s + 1].append(shapley[name])
    return out


AUDIT = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_rows(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in AUDIT] for r in df.collect()}


def test_audit_odd_rows(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gamma"]) + str(rng.randrange(300)) for _ in range(400))
    docs = [
        (1, None, "en"), (2, "", "en"), (3, "", None), (None, "", "en"), (None, "same text", "de"), (4, "same text", "de"),
        (5, "same text", ""), (5, "same text", ""), (5, "another", "en"), (6, long, "en"), (7, long, "de"), (7, long, "en"),
        (8, long + " $", "en"), (9, long + "\x0bX" * 90, "fr"), (10, long + "\x85\xa0", "fr"), (11, "x " * 500, "fr"),
        (12, "É" * 10 + " AB", "fr"), (13, "lorem ipsum " * 90_000, "en"), (-3, "lorem ipsum " * 90_000, "en"),
    ]
    labels = [(1, 1, 0), (4, 0, 1), (4, 1, None), (7, 1, 1), (8, None, 1), (None, 1, 1), (99, 1, 1)]
    df = spark.createDataFrame([(*d, "w", 5, 7) for d in docs], "doc_id long, text string, lang string, _hash string, n long, mask int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audit_rows(filter_audit.audit(df, lab)) == brute_audit(docs, labels)
    assert audit_rows(filter_audit.audit(df.repartition(7), lab.limit(0))) == brute_audit(docs, [])


def test_audit_on_shared_odd_rows(spark):
    df = odd_documents(spark)
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]
    labels = [(i, i % 2, 1) for i in range(12)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audit_rows(filter_audit.audit(df, lab)) == brute_audit(docs, labels)
    assert filter_audit.audit(empty_documents(spark), lab).count() == 0


def test_audit_hot_text(spark, monkeypatch):
    """Copies of one text and a full table of repeated hashes: the same marks, whatever passes."""
    docs = [(i, "the common text" if i % 3 else f"text {i // 6}", "en") for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    want = brute_audit(docs, [])
    assert audit_rows(filter_audit.audit(df, lab)) == want
    monkeypatch.setattr(filter_audit, "TABLE_WORDS", 1)
    assert audit_rows(filter_audit.audit(df, lab)) == want


# ---- mixing -----------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: (source, size) in order. The stated procedure, round by round."""
    total = sum(s for _, s in sizes)
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    fixed = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(fixed.values())
        share = {i: rest * w[i] / sum(w[j] for j in free) for i in free}
        over = [i for i in free if share[i] > most * sizes[i][1]]
        if not over:
            return {sizes[i][0]: fixed.get(i, share.get(i)) for i in range(len(sizes))}
        fixed |= {i: most * sizes[i][1] for i in over}


def brute_sizes(docs):
    by = {}
    for _, t, s in docs:
        by[s] = by.get(s, 0) + len(WORD.findall(t or ""))
    return sorted(by.items(), key=lambda x: (x[0] is None, x[0] or ""))


def frame(spark, docs, parts=3):
    df = spark.createDataFrame([(*d, "x", 1, 2.0) for d in docs], "doc_id long, text string, source string, hash string, rows int, p double")
    return df.repartition(parts) if docs else df


def check_mix(spark, docs, near=None):
    sizes = brute_sizes(docs)
    want, size_of = brute_targets(sizes), dict(sizes)
    got = mixing.mix(frame(spark, docs)).collect()
    source = {}
    for i, t, s in docs:
        source.setdefault((i, len(WORD.findall(t or ""))), []).append(s)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == sorted(
        (i is None, i or 0, len(WORD.findall(t or ""))) for i, t, _ in docs
    )
    taken = dict.fromkeys(size_of, 0)
    for r in got:
        s = source[r["doc_id"], r["size"]][0]
        assert r["source_size"] == size_of[s]
        assert r["target"] == pytest.approx(want[s], rel=1e-12, abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        if size_of[s]:
            rate = want[s] / size_of[s]
            assert math.floor(rate - 1e-9) <= r["copies"] <= math.ceil(rate + 1e-9)
        taken[s] += r["taken"]
    for s in size_of:
        biggest = max(len(WORD.findall(t or "")) for _, t, x in docs if x == s)
        assert abs(taken[s] - want[s]) <= biggest * (1 + 1e-9), s  # at most one document's rounding
        if near is not None:
            assert abs(taken[s] - want[s]) <= near * want[s], s
    again = mixing.mix(frame(spark, docs[::-1], 5)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    return got


def test_mix_many_sources(spark):
    rng = random.Random(3)
    docs = [(i, "w " * rng.randrange(1, 80), f"s{rng.randrange(40) ** 2 // 40}") for i in range(3000)]
    check_mix(spark, docs)


def test_mix_hot_source(spark):
    rng = random.Random(4)
    docs = [(i, "w " * int(rng.paretovariate(1.1) * 5 % 900), "hot" if i % 3 else f"s{i % 5}") for i in range(6000)]
    check_mix(spark, docs, near=0.02)


def test_mix_capped_and_null_sources(spark):
    docs = [(1, "a b c", "A"), (2, "a " * 500, "B"), (3, "a\x0bb\xa0c " * 400, "Z"), (4, "x y", None), (5, None, None), (6, "", "q")]
    got = check_mix(spark, docs)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["taken"] == 9 and by[4]["taken"] in (0, 2, 4, 6) and by[6]["taken"] == 0


def test_mix_repeated_rows_and_null_ids(spark):
    docs = [(7, "a b c d", "hot")] * 2000 + [(None, "e f", "hot")] * 1000 + [(i, "g h i", "z") for i in range(900)] + [(1, "q", "y")] * 5
    check_mix(spark, docs, near=0.05)


def test_mix_nothing(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    got = mixing.mix(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2
    assert mixing.mix(odd_documents(spark)).count() == odd_documents(spark).count()


def test_mix_tree_against_plain_rounding(spark):
    """The tree, node by node, in plain Python on the same hashes and draws."""
    rng = random.Random(6)
    units = [(rng.randrange(4), rng.getrandbits(64) - (1 << 63), rng.randrange(1, 90), rng.random()) for _ in range(9000)]
    df = spark.createDataFrame(units, "source_no long, hash long, size long, p double").repartition(5)
    got = {(r["source_no"], r["hash"], r["size"]): r["bit"] for r in mixing.rounded(df).collect()}
    draw = {}
    for level in range(5):
        for r in df.select("source_no", "hash", mixing._draw(level)).collect():
            draw[level, r["source_no"], r["hash"]] = r["u"]
    want, todo, bits, level = {}, units, 12, 0
    while True:
        nodes = {}
        for u in todo:
            nodes.setdefault((u[0], (u[1] % (1 << 64)) >> (64 - bits)), []).append(u)
        todo = []
        for (s, _), members in nodes.items():
            members.sort(key=lambda u: (-u[2], u[1]))
            _, h, size, p = members[0]
            for _, h2, size2, p2 in members[1:]:
                up, down = min((1 - p) * size, p2 * size2), min(p * size, (1 - p2) * size2)
                rises = draw[level, s, h2] * (up + down) < down
                words = up if rises else -down
                new, new2 = p + words / size, p2 - words / size2
                first_done = (1 - p) * size <= p2 * size2 if rises else p * size <= (1 - p2) * size2
                if first_done:
                    want[s, h, size] = int(rises)
                    h, size, p = h2, size2, min(1.0, max(0.0, new2))
                else:
                    want[s, h2, size2] = int(not rises)
                    p = min(1.0, max(0.0, new))
            todo.append((s, h, size, p))
        if bits == 0:
            break
        bits, level = bits - 6, level + 1
    for s, h, size, p in todo:
        want[s, h, size] = int(draw[level + 1, s, h] < p)
    assert got.keys() == want.keys()
    # Decimal order of sums may turn a draw that falls within rounding of the chance; none does here.
    assert got == want
    for s in range(4):
        own = [u for u in units if u[0] == s]
        words, mean = sum(want[u[:3]] * u[2] for u in own), sum(u[3] * u[2] for u in own)
        assert abs(words - mean) <= 90


def test_mix_chances(spark):
    """Over many ids each copy count comes as often as it is expected."""
    docs = [(i, "a b c", "s") for i in range(4000)] + [(i, "a b c", "t") for i in range(4000, 8000)]
    copies = {}
    for r in mixing.mix(frame(spark, docs)).collect():
        copies.setdefault(r["doc_id"] >= 4000, []).append(r["copies"])
    for v in copies.values():
        half = np.mean(v[:2000]), np.mean(v[2000:])
        assert abs(half[0] - half[1]) < 0.1


# ---- codebooks --------------------------------------------------------------------------


def brute_codes(rows, rounds=4, entries=256):
    """rows: (vec_id, ints); ids distinct. Plain integer distances, round by round."""
    x = np.array([v for _, v in rows], np.int64).reshape(len(rows), 4, -1)
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])[:entries]
    book = x[order].transpose(1, 0, 2).copy()

    def assign():
        return np.stack([((x[:, p, None, :] - book[p][None]) ** 2).sum(2).argmin(1) for p in range(4)], 1)

    for _ in range(rounds):
        code = assign()
        for p in range(4):
            for e in set(code[:, p]):
                own = x[code[:, p] == e, p]
                book[p, e] = own.sum(0) // len(own)
    code = assign()
    error = sum(((x[:, p] - book[p][code[:, p]]) ** 2).sum(1) for p in range(4))
    return {i: ("".join(f"{c:02x}" for c in code[k]), int(error[k])) for k, (i, _) in enumerate(rows)}, book


def vectors(spark, rows, parts=3):
    df = spark.createDataFrame(
        [(i, v, label, 3, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, ints int, code string"
    )
    return df.repartition(parts) if rows else df


def check_codes(spark, rows, parts=3):
    """rows: (vec_id, vector, label), ids distinct, all kept."""
    ints = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v, _ in rows]
    want, book = brute_codes(ints)
    labels = {}
    for i, _, label in rows:
        labels[label] = labels.get(label, 0) + want[i][1]
    got = codebooks.encode(vectors(spark, rows, parts)).collect()
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want and len(got) == len(rows)
    assert {r["vec_id"]: r["label_error"] for r in got} == {i: labels[label] for i, _, label in rows}
    import hashlib

    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(codebooks.books_text(book).encode()).hexdigest()}


def test_codes_of_random_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 0.2, 16).tolist(), int(i) % 3 if i % 7 else None) for i in rng.permutation(1500)]
    check_codes(spark, rows)
    check_codes(spark, rows[:40], parts=1)  # fewer vectors than entries


def test_codes_with_ties_and_copies(spark):
    """Coarse components make many equal distances; one vector is a third of all rows."""
    rng = np.random.default_rng(2)
    rows = [(i, [0.5] * 8 if i % 3 == 0 else (rng.integers(-3, 4, 8) / 512).tolist(), 1) for i in range(1200)]
    check_codes(spark, rows)


def test_codes_of_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 20_000, 8).clip(-60_000, 60_000)).tolist(), i % 2) for i in range(500)]
    check_codes(spark, rows)


def test_bounds_spare_scans_and_change_nothing():
    rng = np.random.default_rng(4)
    ints = (rng.normal(0, 1, (3000, 1, 16)) * 20 + rng.integers(0, 12, (3000, 1, 1)) * 300).astype(np.int32)
    ints = np.repeat(ints, 4, axis=1)
    history = [ints[:256].astype(np.int64).transpose(1, 0, 2).copy()]
    state = codebooks.State(ints, 256)
    scanned = []
    for t in range(5):
        before = state.scanned
        moves = codebooks.Moves(history)
        state.assign(history, moves, first=t == 0)
        scanned.append(state.scanned - before)
        for p in range(4):
            d2 = ((ints[:, p, None, :].astype(np.int64) - history[-1][p][None]) ** 2).sum(2)
            assert (state.code[:, p] == d2.argmin(1)).all()
            # Every stamped bound holds for the codebook of its round.
            for b, entries in enumerate(moves.blocks[p]):
                other = d2.copy()
                other[np.arange(len(ints)), state.code[:, p]] = np.iinfo(np.int64).max
                fresh = state.near_round[:, p, b] == t
                low = other[:, entries].min(1)
                assert (state.near[fresh, p, b] <= np.sqrt(low[fresh])).all()
        book = history[-1].copy()
        for p in range(4):
            for e in set(state.code[:, p]):
                own = ints[state.code[:, p] == e, p].astype(np.int64)
                book[p, e] = own.sum(0) // len(own)
        history.append(book)
    assert scanned[0] == 3000 * 4 * 256 and max(scanned[1:]) < scanned[0] / 2


def test_true_moves_are_tighter_than_sums_of_moves():
    """An entry that goes and comes back has not moved."""
    a, b = np.zeros((4, 2, 3), np.int64), np.ones((4, 2, 3), np.int64)
    assert (codebooks.Moves([a, b, a]).entry[0] == 0).all()
    assert (codebooks.Moves([a, b, a]).entry[1] >= math.sqrt(3)).all()


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (1, [0.1, 0.2, 0.3, 0.4, 0.5], 1), (2, None, 1), (3, [0.1, None, 0.3, 0.4, 0.5], 1), (4, [nan] * 5, 1), (5, [inf, 0.0, 0.0, 0.0, 0.0], 1),
        (6, [-0.1, 0.2, 0.3, 0.4, 0.5], None), (6, [-0.2, 0.2, 0.3, 0.4, 0.5], 1), (6, [-0.2, 0.2, 0.3, 0.4, 0.5], 1),
        (None, [0.9, 0.2, 0.3, 0.4, 0.5], None), (7, [0.1] * 4, 1), (8, [], 1), (9, [1e30, -1e30, 0.0, -0.0, 1e-30], 2),
    ]
    got = codebooks.encode(vectors(spark, odd)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == [(False, 1)] + [(False, 6)] * 3 + [(False, 9), (True, 0)]
    by = {r["vec_id"]: r for r in got}
    assert by[9]["error"] == 0 and by[9]["code"] == "02" + "02" + "02" + "00"
    assert len({r["codebooks_sha256"] for r in got}) == 1
    for empty in ([], [(1, None, 2)], [(None, [0.5] * 4, 3)]):
        out = codebooks.encode(vectors(spark, empty)).collect()
        assert [(r["code"], r["error"], r["label_error"]) for r in out] == ([(None, None, None)] if empty and empty[0][1] else [])
    blank = codebooks.encode(vectors(spark, [(1, [], 1), (2, [], 1)])).collect()
    assert [(r["code"], r["error"]) for r in blank] == [("00000000", 0)] * 2
