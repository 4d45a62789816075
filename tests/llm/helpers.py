"""Small awkward tables for the training-data operators."""

LONG = "lorem ipsum dolor sit amet " * 4000

#: id, text, lang, source, n_chars, and columns whose names the operators use inside
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size int, fp string, shard int"


def docs(spark, rows):
    """Rows of (doc_id, text, source); the clashing columns are filled with noise."""
    return spark.createDataFrame([(i, t, None, s, None if t is None else len(t), 0.5, 7, "x", None) for i, t, s in rows],
                                 DOCS)


AWKWARD = [
    (1, "Alpha beta gamma delta epsilon", "a"),
    (2, "Alpha beta gamma delta epsilon", "a"),          # a copy
    (3, None, "a"),
    (4, "", None),
    (5, " \t\n\r\x0b\x0c ", "b"),
    (6, LONG, "b"),
    (7, "one", "c"),
    (7, "one", "c"),                                     # a repeated row
    (None, "no id here at all", "c"),
    (8, "Ñandú ÉCOLE straße 漢字 \U0001f600", ""),
    (9, "a  b   c\n\nd", None),
]
