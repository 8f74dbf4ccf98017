"""Small tables with everything that may go wrong in one column or another."""

from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} tail" for i in range(20_000))

ROWS = [
    (1, "Some plain words stand here, more than a few of them in all.", "en", "a", 10),
    (2, "Some plain words stand here, more than a few of them in all.", "en", "b", None),
    (2, "Some plain words stand here, more than a few of them in all.", "en", "b", None),
    (3, "", "en", None, 0),
    (4, None, None, "a", None),
    (None, "A text without an id", "en", "a", 3),
    (None, "A text without an id", "en", "a", 3),
    (None, None, None, None, None),
    (5, "x", "", "", 1),
    (6, " \t\n", "en", "c", 3),
    (7, LONG, "en", "a", len(LONG)),
    (8, LONG, "en", "d", len(LONG)),
    (9, "ab" * 30_000, "en", "d", 60_000),
    (10, "Größe, straße, été \x00 nul \U0001f600", "de", "d", 5),
    (2, "Another text with an id that was there before.", "en", "b", None),
]

CLASHES = {
    "size": "1", "shard": "2", "kept": "true", "uid": "3", "fp": "4", "tie": "5", "key": "6", "rank": "7", "block": "8",
    "__group": "9", "__uid": "10", "__text": "11", "__part": "12", "hub": "13", "draw": "14", "copies": "15", "host": "16",
    "rule": "17", "vector": "18", "__row": "19", "trusted": "20", "text_hash": "21", "part": "22", "rows": "23",
}


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(spark, df):
    """``df`` with further columns under names that operators use inside."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(v).alias(k) for k, v in CLASHES.items() if k not in df.columns))


def empty(spark):
    return spark.createDataFrame([], T.StructType.fromDDL(DOCUMENTS))
