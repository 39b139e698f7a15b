"""Hand-made frames that every operator must take."""

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, one id for two texts."""
    rows = [
        (1, "one two three four five six seven", "en", "a", 33),
        (1, "one two three four five six seven", "en", "a", 33),
        (1, "another text under the same number", "en", "a", 34),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \t\n ", "en", "b", 4),
        (None, "one two three four five six seven", "en", None, 33),
        (None, None, None, None, None),
        (5, LONG, "en", "c", len(LONG)),
        (6, LONG, "en", "c", len(LONG)),
        (7, "Ünïcödé 日本 語　x\x85y z\x1cw 😀 password: hunter2hunter2", "xx", "ß", 1),
        (-8, "x", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCUMENT)


def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


def clashing(df):
    """Extra columns named like results and helpers of the operators."""
    from pyspark.sql import functions as F

    names = ("size", "kept", "n_words", "rate", "copies", "target", "fp", "root", "node", "words", "h", "_text", "host", "start", "n_tokens", "k", "found", "body", "item", "_row", "_key", "_alike", "_copies", "_rows", "_copy", "passes")
    return df.withColumns({n: F.lit("clash") for n in names})
