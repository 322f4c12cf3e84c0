"""Small tables of documents with all that may go wrong in them."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows, extra=""):
    """Documents of (doc_id, text, lang, source[, ...])."""
    return spark.createDataFrame([(r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1]), *r[4:]) for r in rows], DOCS + extra)


#: nulls in every column, empty, blank and long texts, repeated rows, ties, control and foreign characters
ODD = [
    (None, None, None, None),
    (None, "a null id with some words", "en", "a"),
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \n\t ", None, "a"),
    (4, "word " * 30_000, "en", "a"),
    (5, "the same row twice, and more words in it", "en", "a"),
    (5, "the same row twice, and more words in it", "en", "a"),
    (5, "the same id with other words", "fr", "b"),
    (6, "é\u0000  中文 without blanks 😀\r\n", "", ""),
]
CLASH = ", words int, metric string, bucket string, n string, id string, h string, rate string, gone string, fp string, __n string, token string, pos string, line string"
CLASHING = tuple([7, *("x" for _ in range(12))])
EMPTY: list = []


def odd(spark):
    return docs(spark, [(*r, *CLASHING) for r in ODD], CLASH)


def rows(df, *columns):
    return sorted(df.select(*(columns or df.columns)).collect(), key=str)
