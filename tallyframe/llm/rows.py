"""Helpers shared by the operators: safe column access, whole-row packing, reliable checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import checkpoint_dir

#: Fixed: the ASCII white space that separates words, `[\x20\x09-\x0D]`.
WHITE = " \t\n\u000b\f\r"
#: Fixed: a word is a run of anything else.
WORD = "[^ \\t\\n\\x0B\\f\\r]+"


def col(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that no input name can clash with an operator's own columns."""
    return F.struct(*[col(c).alias(c) for c in df.columns])


def unpacked(df: DataFrame, field: str, columns: list[str]) -> DataFrame:
    """The original columns back from the struct ``field``."""
    return df.select(*[F.col(field).getField(c).alias(c) for c in columns])


def text_of(name: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read from there from now on."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, gone when the application ends.

    For loops: a checkpoint keeps the size estimate of the plan behind it, and estimates of repeated joins multiply,
    while a table is as large as its files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def beside(df: DataFrame, row: DataFrame, by: str) -> DataFrame:
    """Every row of ``df`` with the single row of ``row`` (an aggregate without grouping), which is broadcast.

    The key is zero on both sides but not a literal, so the join stays a hash join and not a product.
    """
    zero = lambda *of: F.xxhash64(*of).bitwiseAND(F.lit(0).cast("long"))
    single = F.broadcast(row.withColumn("one", zero(*row.columns)))
    return df.withColumn("one", zero(by)).join(single, "one").drop("one")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
