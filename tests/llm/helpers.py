"""Plain second implementations and frames with hard rows."""

HARD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "one two"), (7, "Ünï \U0001f600 çé " * 40),
    (8, "a b c d e f g h " * 3000), (8, "a b c d e f g h " * 3000), (None, "nobody knows this text"), (9, "x" * 50000),
]


def documents(spark, rows=None):
    """Documents with columns that clash with names the operators use."""
    rows = [(i, t, "en", "s", len(t or ""), i, "x", "r", "k", "t", 1, 2.5, "m") for i, t in (HARD_TEXTS if rows is None else rows)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row long, key string, _row string, "
        "_key string, _text string, _label int, _c double, _m string"
    )
