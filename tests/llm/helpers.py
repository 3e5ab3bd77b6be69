"""Tables the tests of the text operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GIVEN = "/root/testdata"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text, lang, source); further columns carry names the operators use themselves."""
    full = [(*row, None if row[1] is None else len(row[1])) for row in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.selectExpr("*", "'x' as key", "1.5 as n_words", "'y' as words", "7 as score", "'z' as TEXT", "doc_id as ids",
                         "0 as block", "'e' as epoch", "1 as sig", "0 as held_out", "'s' as spans", "2 as slot")


#: Nulls in every column, empty and long texts, ties and repeated rows, odd white space and letters.
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "word", None, "a"), (None, "a text without an id", "en", "b"),
    (4, "same text here for two rows of the table", "en", None), (4, "same text here for two rows of the table", "en", None),
    (5, "long " * 30_000, "en", "b"), (6, "x" * 100_000, "fr", "b"), (7, "\n\t \x0b\x0c\r\u00a0\u2003", "de", ""),
    (8, "\u00c9t\u00e9 \u6f22\u5b57 \U0001f600 \u0661\u0662 \x00 end", "fr", "c"), (9, "<|endoftext|> a <|endoftext|>", "en", "c"),
    (10, None, None, None), (-3, "1.2.3.4 and a@b.c", "en", "a"),
]


def plain_rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((v is None, str(v)) for v in row))
