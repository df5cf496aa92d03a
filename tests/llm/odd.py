"""Rows every operator must take: nulls, empty and long texts, repeats, clashing columns."""

LONG = ("lorem ipsum dolor sit amet " * 9000) + "mail a.b@example.com +49 (030) 1234-567 under the MIT license"
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\r "),
    (4, "one"),
    (5, "one two three four"),
    (6, LONG),
    (7, "under the MIT license. Under the mit license"),
    (7, "under the MIT license. Under the mit license"),
    (None, "a row without an id but with quite a few words of text in it"),
    (8, "ä\U0001f600 x token = 'abcdef123' ß 10.0.0.1 🙂 4111 1111 1111 1111"),
    (9, "a row without an id but with quite a few words of text in it"),
    (10, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15\n\n1 2 3 4 5\n1 2 3 4 5"),
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, _words string, "
    "_row int, n long, kind string, cls string, _copy long, _bad long, region string, key string, hub int"
)


def odd_documents(spark, rows=TEXTS):
    extra = ("x", 1, "k", "c", 5, 6, "r", "y", 7)
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), 0.5, "w", *extra[1:2], 3, "k", "c", 5, 6, "r", "y", 7) for i, t in rows],
        SCHEMA,
    )


def empty_documents(spark):
    return odd_documents(spark).limit(0)
