"""Small tables with everything that may go wrong, for all operators."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use inside.
    *[T.StructField(name, T.StringType()) for name in ("row", "id", "check", "key", "size", "words", "epoch", "lines", "starts", "pos", "spans")],
])
EXTRA = (None,) * 11


def docs(spark, rows):
    """Documents of (id, text[, lang[, source]]) rows."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *(None,) * (4 - len(r)))
        full.append((doc_id, text, lang, source, None if text is None else len(text), *EXTRA))
    return spark.createDataFrame(full, DOCS)


LONG = "alpha beta gamma delta " * 6_000

ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\n ", "en", None), (4, LONG, "fr", "a"), (5, LONG, "fr", "a"),
    (5, LONG, "fr", "a"), (None, "no id here", "en", "b"), (None, None, None, "b"), (6, "Ünïcode 漢字 — ok", "de", "b"),
    (7, "x", "en", "a"), (7, "y", "en", "a"), (8, "0" * 50_000, None, "c"), (9, "- - - ...", "en", "c"),
]
