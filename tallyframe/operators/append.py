"""Validated append: accept candidate rows whose parent row is eligible."""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def validate_candidates(candidates: DataFrame, parents: DataFrame, key, eligible: Column,
                        carry_cols=(), checks: dict[str, Column] | None = None) -> DataFrame:
    """Candidates with a ``reject_reason`` column (NULL = accepted).

    ``parents`` is reduced to one row per key (eligible if any parent row is,
    carried columns taken from an eligible row, of several the one with the
    greatest carried values), so a duplicated parent key cannot duplicate a
    candidate.  ``checks`` maps a reason to a condition
    every accepted row must meet (e.g. a rating range).
    """
    keys = _cols(key)
    carry_cols = _cols(carry_cols)
    best = F.struct(F.coalesce(eligible, F.lit(False)).alias("_eligible"), *[F.col(c) for c in carry_cols])
    per_key = parents.groupBy(*keys).agg(F.max(best).alias("_best")).select(
        *keys, *[F.col("_best")[c].alias(c) for c in ("_eligible", *carry_cols)])
    joined = candidates.join(per_key, on=keys, how="left")
    reason = F.when(F.col("_eligible").isNull(), F.lit("unknown parent")) \
        .when(~F.col("_eligible"), F.lit("parent not eligible"))
    for why, cond in (checks or {}).items():
        reason = reason.when(~F.coalesce(cond, F.lit(False)), F.lit(why))
    return joined.withColumn("reject_reason", reason).drop("_eligible")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reject_reason").isNotNull())


def _path(spark: SparkSession, path: str):
    """(file system, qualified path) of a folder that all executors reach."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(where)


def _publish(spark: SparkSession, target: str, batch_id: str, manifest: dict) -> bool:
    """Make a batch visible: its manifest gets its name in one step, unless the name is taken already."""
    jvm = spark._jvm
    fs, draft = _path(spark, f"{target}/_drafts/{uuid.uuid4().hex}")
    _, final = _path(spark, _manifest_path(target, batch_id))
    fs.mkdirs(final.getParent())
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # never overwrite
    try:
        context.rename(draft, final, keep)
    except Py4JJavaError as e:
        if not fs.exists(final):
            raise e
        fs.delete(draft, False)
        return False  # another run of the batch was first
    return True


def _manifest_path(target: str, batch_id: str) -> str:
    return f"{target}/_commits/{quote(batch_id, safe='')}.json"


def manifests(spark: SparkSession, target: str) -> dict[str, dict]:
    """The committed batches of a target by their ids; one small file each."""
    fs, folder = _path(spark, f"{target}/_commits")
    if not fs.exists(folder):
        return {}
    found = {}
    for status in fs.listStatus(folder):
        stream = fs.open(status.getPath())
        try:
            manifest = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        found[manifest["batch"]] = manifest
    return found


def append_batch(rows: DataFrame, target: str, batch_id: str, part_col: str, fmt: str = "parquet") -> dict:
    """Write ``rows``, split by the values of ``part_col``, to ``target`` as the batch ``batch_id`` and commit it; returns
    its manifest.

    A run writes into a folder of its own, which nobody reads; only the manifest, written last and under the batch's
    name, makes the folder part of the table.  A batch that was committed before is left as it is, and of two runs at
    once the first to commit counts, so a batch that runs again after a failure at any point is appended once.
    """
    spark = rows.sparkSession
    done = manifests(spark, target).get(batch_id)
    if done:
        return done
    folder = f"data/{quote(batch_id, safe='')}-{uuid.uuid4().hex}"
    rows.write.partitionBy(part_col).format(fmt).save(f"{target}/{folder}")
    schema = StructType([f for f in rows.schema.fields if f.name != part_col])
    manifest = {"batch": batch_id, "folder": folder, "format": fmt, "part": part_col, "schema": schema.jsonValue()}
    return manifest if _publish(spark, target, batch_id, manifest) else manifests(spark, target)[batch_id]


def read_batches(spark: SparkSession, target: str, part: str, batches=None) -> DataFrame:
    """The rows of one part of the committed batches (all, or those listed).  Folders of runs that never came to commit are
    not looked at.  At least one batch has to be committed."""
    found = [m for b, m in sorted(manifests(spark, target).items()) if batches is None or b in batches]
    if not found:
        raise ValueError(f"no committed batch in {target}")
    schema = StructType.fromJson(found[0]["schema"])
    if any(m["schema"] != found[0]["schema"] or m["format"] != found[0]["format"] for m in found):
        raise ValueError("the batches have different columns")
    paths = [f"{target}/{m['folder']}/{m['part']}={part}" for m in found]
    there = [p for p in paths if (lambda fs, q: fs.exists(q))(*_path(spark, p))]  # a batch may lack a part
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(found[0]["format"]).load(there)


def validated_append(candidates: DataFrame, parents: DataFrame, key, eligible: Column, target_path: str,
                     target_cols, batch_id: str, carry_cols=(), checks: dict[str, Column] | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """Append the accepted candidates to ``target_path`` as one batch and return the batch's rejects.

    One job validates and writes accepted and rejected rows side by side, so both come from the same validation, and the
    rejects are kept.  Running a batch again appends nothing (``append_batch``).  :func:`appended` reads the table.
    """
    spark = candidates.sparkSession
    v = validate_candidates(candidates, parents, key, eligible, carry_cols, checks)
    columns = [*_cols(target_cols), *[c for c in v.columns if c not in _cols(target_cols)]]
    kind = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    append_batch(v.select(*columns).withColumn("verdict", kind), target_path, batch_id, "verdict", fmt)
    return read_batches(spark, target_path, "rejected", [batch_id])


def appended(spark: SparkSession, target_path: str, target_cols=None) -> DataFrame:
    """The rows that all committed batches appended."""
    rows = read_batches(spark, target_path, "accepted").drop("reject_reason")
    return rows.select(*_cols(target_cols)) if target_cols else rows
