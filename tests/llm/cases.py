"""Tables with nulls, empty and very long texts, ties, repeated rows and clashing column names."""

from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or give back.
CLASHING = ["id", "row", "key", "kept", "keep_id", "size", "taken", "copies", "sha", "norm", "best", "h", "t", "fp", "shard", "length", "bits", "chunk", "a.b"]


def odd_rows():
    long = "word " * 60_000
    return [
        (1, "Alpha beta gamma delta.", "en", "s1", 1), (2, "Alpha  beta\tgamma delta.", "en", "s1", 2),
        (3, "alpha beta gamma delta.", None, None, None), (4, None, "en", "s2", None), (5, "", None, "s2", 0),
        (6, " \n\t ", "de", None, 3), (7, long, "en", "s1", len(long)), (8, long + " ", "en", "s1", None),
        (9, "Alpha beta gamma delta.", "en", "s1", 1), (9, "Alpha beta gamma delta.", "en", "s1", 1),
        (None, "Alpha beta gamma delta.", "en", "s1", 1), (None, "nobody knows my number", "en", "s3", 1),
        (None, "nobody knows my number", "en", "s3", 1), (10, "é ü 😀 x", "fr", "s2", 7), (11, "퟿\u0000 nul", "xx", "s2", 7),
        (12, "one", "en", "s1", 3), (13, "one two", "en", "s1", 7),
    ]


def documents(spark, rows=None, clashing=False):
    rows = odd_rows() if rows is None else rows
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clashing:
        extra = T.StructType(df.schema.fields + [T.StructField(c, T.StringType()) for c in CLASHING])
        df = spark.createDataFrame([(*r, *[f"x{i}" for i in range(len(CLASHING))]) for r in rows], extra)
    return df


def files(spark, folder, docs, labels=()):
    """A folder like a scale-factor folder."""
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return str(folder)
