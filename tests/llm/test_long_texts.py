"""Long texts of few kinds of characters: values by rule, and time that does not grow with the square."""

import hashlib
import random
import re
import time

import pytest

from meterline.llm import filter_audit, licenses, mixing, pii, quality

RNG = random.Random(1)
NOTICES = "under the MIT license. " * 20_000
LETTERS = "a" * 1_000_000
CHINESE = "".join(chr(0x4E00 + RNG.randrange(5000)) for _ in range(1_000_000)) + "7@x.org"
DIGITS = "7" * 1_000_000
RUNS = ("1" * 1000 + ".") * 1000
TEXTS = {"notices": NOTICES, "letters": LETTERS, "chinese": CHINESE, "digits": DIGITS, "runs": RUNS}
SECONDS = 20  # a slow test machine; the quadratic versions took minutes to hours


def one(spark, text):
    return spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def field(spark, documents):
    return pii.train(documents)


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_licenses(spark, name):
    licenses.label_digests(one(spark, "under the MIT license")).collect()  # compiled before
    start = time.perf_counter()
    r = licenses.label_digests(one(spark, TEXTS[name])).collect()[0]
    assert time.perf_counter() - start < SECONDS
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", TEXTS[name].lower())
    assert r["n_words"] == len(words)
    at = [i for i in range(len(words)) if words[i : i + 4] == ["under", "the", "mit", "license"]]
    assert r["n_base"] == len(at)
    assert (r["first_word"], r["last_word"]) == ((at[0], at[-1]) if at else (None, None))
    assert r["base_labels"] == ("mit" if at else "")


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_personal_data(spark, field, name):
    start = time.perf_counter()
    r = pii.scan_digests(one(spark, TEXTS[name]), field).collect()[0]
    assert time.perf_counter() - start < SECONDS
    spans = ""
    if name == "chinese":
        spans = "email:1000000:1000007"
        assert CHINESE[1_000_000:] == "7@x.org"
    assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (int(name == "chinese"), 0, 0, 0)


def test_matches_of_many_chunks(spark):
    """More matches than a chunk holds, with intervals that suppress others on both sides of its edges."""
    rng = random.Random(9)
    pieces = ["under the MIT license", "MIT license", "apache license version 2", "cc by nc", "licensed under the apache license 2 0", "some other words"]
    text = ". ".join(rng.choice(pieces) for _ in range(1500))
    got = licenses.detect(one(spark, text)).collect()[0]
    whole = licenses.CHUNK
    try:
        licenses.CHUNK = 1 << 20  # everything in one chunk
        want = licenses.detect(one(spark, text)).collect()[0]
        licenses.CHUNK = 3
        small = licenses.detect(one(spark, text)).collect()[0]
    finally:
        licenses.CHUNK = whole
    assert len(got["found"]) > 2 * whole and got == want == small
    stronger = [(d["start"], d["end"]) for d in got["found"]]
    for a, b in zip(stronger, stronger[1:]):
        assert a[0] <= b[0]


def test_other_operators_take_them(spark):
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(TEXTS.values())], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix(docs).collect()}
    assert sizes == {i: len(t.split()) for i, t in enumerate(TEXTS.values())}
    rows = [r for r in filter_audit.audit(docs, labels).collect() if r["filter_order"] == "ABCDE"]
    assert [r["kept"] for r in sorted(rows, key=lambda r: r["step"])] == [1, 0, 0, 0, 0]
    words = {r["doc_id"]: r["n_words"] for r in quality.judge(docs, labels).collect()}
    assert words == sizes


def test_field_learns_from_long_texts(spark):
    """A table of long texts alone trains the field as short ones do."""
    filler = " ".join(f"word{i % 97}" for i in range(6000))
    texts = [f"{filler} mail a{i}.b@example.com or call +49 (030) 123-45{i:02d} now {i} {filler}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learned, direct = pii.train(docs), pii.SkipChain.fit(texts)
    assert abs(learned.unary - direct.unary).max() < 1e-6
    assert (abs(learned.unary) > 0.1).sum() > 50  # an untrained field has one weight, the bias
