"""Small odd tables that every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, n string, keys int, _own int, component string, ids string"


def odd(spark, rows=None):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    long_text = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = rows if rows is not None else [
        (1, "One two three four five", "en", "a"), (2, "one two three four FIVE", "en", "b"), (2, "one two three four FIVE", "en", "b"),
        (3, None, None, None), (None, "one two three four five", "en", "a"), (None, None, None, "a"), (4, "", "de", "b"),
        (5, long_text, "en", "a"), (6, long_text + " more", "en", "c"), (7, "  \n\t ", "fr", "a"), (8, "É é ÀÉ", "fr", "www.x.fr"),
        (9, "same\nline\n\nsame", "xx-not-a-lang", "c"), (10, "z", "en", "c"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "h", "n", 1, 2, "c", "i") for r in rows], SCHEMA)


def empty(spark):
    return odd(spark, [])
