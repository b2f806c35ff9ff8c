"""What the tests of the training-data operators share."""

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, own string, slot int, rank int, tree int, h long, a long"


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


#: Texts that are null, empty, blank, short, equal, nearly equal, long and odd; a repeated row, a null doc_id, a repeated doc_id.
PROSE = " ".join(f"word{i % 97} and{i % 13} thing{i}" for i in range(400))
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "one"),
    (6, PROSE),
    (7, PROSE),
    (8, PROSE.replace("thing7 ", "other7 ", 1)),
    (9, "x" * 200),
    (10, "x" * 120 + "é" * 40),
    (11, "日本語 " * 60 + "<|endoftext|> ok\u0000 end"),
    (12, "ÀB c d E f g"),
    (12, "another text under the same number, which is long enough to have fifty bytes and some"),
    (13, "same row"),
    (13, "same row"),
    (None, PROSE),
    (None, None),
]


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.where(F.col("doc_id").isNotNull()).select("doc_id", "text").collect()}
