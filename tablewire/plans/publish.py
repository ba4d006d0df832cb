"""Staged, committed and versioned table writes.

Below the path of a table::

    _blocks/upload_id=<id>/v=<attempt>/<partition>/block_id=<n>/*.parquet
    _manifest/upload=<id>/      one row per file that the upload adds
    _commits/version=<n>/       one row that names the upload; writing it is the publish step

Staged files are never moved.  A reader keeps the rows of exactly those files that
the manifests of committed uploads name, so files of an upload that was not
committed, that failed half way, or that a late task left behind are never seen.
Of two writers that reach the same version one fails on the commit folder, and
the manifest it wrote under its own upload is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewire.operators.blocks import BLOCK, oversize_field, row_bytes
from tablewire.sources.catalog import declared_columns, schema_json
from tablewire.sources.scan import partition_values

ROW_BYTES = "_row_bytes"

MANIFEST_SCHEMA = (
    "upload_id string, v int, block_id bigint, partition string, file_name string, "
    "raw_size bigint, record_count bigint, dir string"
)
COMMIT_SCHEMA = "upload_id string, overwrite boolean, partition string, row_schema string, partition_by string"


@dataclass(frozen=True)
class Upload:
    """An open write transaction."""

    path: str
    upload_id: str
    overwrite: bool
    partition: str | None
    max_field_size: int | None
    partition_by: tuple[str, ...] = field(default=())

    def describe(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The transaction as one row."""
        keys = set(self.partition_by)
        declared = declared_columns(schema)
        columns = [c for c in declared if c.name not in keys]
        text = schema_json(columns, [c for c in declared if c.name in keys])
        return spark.createDataFrame(
            [(self.upload_id, self.overwrite, self.max_field_size, self.partition, text, "normal")],
            "upload_id string, is_overwrite boolean, max_field_size bigint, "
            "partition string, columns string, status string",
        )


def _canonical_partition(spec: str | None) -> str | None:
    if spec is None:
        return None
    return "/".join(f"{k}={v}" for k, v in partition_values(spec).items())


def create_upload(
    path: str,
    overwrite: bool = False,
    partition: str | None = None,
    partition_by: Sequence[str] = (),
    max_field_size: int | None = None,
    upload_id: str | None = None,
) -> Upload:
    """Open a write: append, overwrite the table, or overwrite one partition."""
    spec = _canonical_partition(partition)
    if spec is not None and list(partition_values(spec)) != list(partition_by):
        raise ValueError("the partition spec must name every partition column, in order")
    return Upload(
        path.rstrip("/"),
        upload_id or uuid.uuid4().hex,
        overwrite,
        spec,
        max_field_size,
        tuple(partition_by),
    )


# -- staging --------------------------------------------------------------


def stage_blocks(
    df: DataFrame, upload: Upload, attempt: int = 0, rebalance: bool = True, check: bool = True
) -> DataFrame:
    """Write the rows of ``df``, which carry ``block_id``, as files of the upload.

    Returns the staged rows.  The exchange is a rebalance by block, which splits
    a block that holds much of the data over several tasks and files; without
    ``rebalance`` every task writes the blocks that it has.
    Sending a block again under a higher ``attempt`` replaces it, within its
    partition, at commit.  A
    value over the field limit of the upload fails the job.  ``check=False`` is
    for callers that know the upload to be open.
    """
    if check and is_committed(df.sparkSession, upload.path, upload.upload_id):
        raise ValueError(f"upload {upload.upload_id} is already committed")
    sized = T.StructType([f for f in df.schema.fields if f.name != BLOCK])
    counted = df.withColumn(ROW_BYTES, row_bytes(sized))
    if upload.max_field_size is not None:
        too_long = oversize_field(sized, upload.max_field_size)
        counted = counted.withColumn(
            ROW_BYTES,
            F.when(too_long.isNull(), F.col(ROW_BYTES)).otherwise(
                F.raise_error(F.concat(F.lit("field over the size limit: "), too_long)).cast("long")
            ),
        )
    target = f"{upload.path}/_blocks/upload_id={upload.upload_id}/v={attempt}"
    if rebalance:
        counted = counted.hint("rebalance", *upload.partition_by, BLOCK)
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*upload.partition_by, BLOCK)
        .parquet(target)
    )
    row_schema = T.StructType([*sized.fields, T.StructField(BLOCK, T.LongType())])
    return df.sparkSession.read.schema(row_schema).parquet(target)


def _decoded(path: Column) -> Column:
    """A path without percent escapes; a plus sign is itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _staged_files(spark: SparkSession, upload: Upload) -> DataFrame:
    """One row per staged file.  Only the row sizes are read, not the rows."""
    root = f"{upload.path}/_blocks"
    own = f"{root}/upload_id={upload.upload_id}"
    try:
        staged = spark.read.schema(f"{ROW_BYTES} bigint").parquet(own)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    path = F.col("_metadata.file_path")
    per_file = staged.groupBy(path.alias("file_path")).agg(
        F.sum(ROW_BYTES).alias("raw_size"), F.count(F.lit(1)).alias("record_count")
    )
    inside = F.substring_index(_decoded(F.col("file_path")), "/_blocks/", -1)
    pieces = F.split(inside, "/")
    count = F.size(pieces)
    return per_file.select(
        F.lit(upload.upload_id).alias("upload_id"),
        F.regexp_extract(inside, "/v=([0-9]+)/", 1).cast("int").alias("v"),
        F.substring_index(F.element_at(pieces, count - 1), "=", -1).cast("long").alias(BLOCK),
        # Folder names escape some characters of a value once more.
        _decoded(F.array_join(F.slice(pieces, F.lit(3), count - 4), "/")).alias("partition"),
        F.element_at(pieces, count).alias("file_name"),
        "raw_size",
        "record_count",
        F.array_join(F.slice(pieces, F.lit(1), count - 1), "/").alias("dir"),
    )


# -- commit ---------------------------------------------------------------


def _commits(spark: SparkSession, path: str) -> list[Row]:
    """The commit log, one small row per commit, oldest first."""
    try:
        log = spark.read.schema(f"{COMMIT_SCHEMA}, version int").json(f"{path.rstrip('/')}/_commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(log.collect(), key=lambda r: r["version"])


def is_committed(spark: SparkSession, path: str, upload_id: str) -> bool:
    return any(r["upload_id"] == upload_id for r in _commits(spark, path))


def current_version(spark: SparkSession, path: str) -> int:
    log = _commits(spark, path)
    return log[-1]["version"] if log else 0


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``(…, version)`` rows of every published file, replaced ones included."""
    return _manifest(spark, path, [r for r in _commits(spark, path) if version is None or r["version"] <= version])


def _manifest(spark: SparkSession, path: str, log: list[Row]) -> DataFrame:
    """The manifest rows of the commits in ``log``; manifests of refused commits are not among them."""
    if not log:
        return spark.createDataFrame([], f"{MANIFEST_SCHEMA}, version int")
    versions = spark.createDataFrame([(r["upload_id"], r["version"]) for r in log], "upload string, version int")
    rows = spark.read.schema(f"{MANIFEST_SCHEMA}, upload string").parquet(f"{path.rstrip('/')}/_manifest")
    return rows.join(versions, "upload").drop("upload")


def commit_upload(spark: SparkSession, upload: Upload, row_schema: T.StructType) -> DataFrame:
    """Publish what was staged and return the manifest rows of the new version.

    Only the newest attempt of a block of a partition is published.  An upload
    without blocks publishes an empty manifest.
    """
    log = _commits(spark, upload.path)
    if any(r["upload_id"] == upload.upload_id for r in log):
        raise ValueError(f"upload {upload.upload_id} is already committed")
    version = log[-1]["version"] + 1 if log else 1
    files = _staged_files(spark, upload)
    if upload.partition is not None and not files.where(F.col("partition") != upload.partition).isEmpty():
        raise ValueError(f"staged rows outside the partition {upload.partition}")
    newest = files.groupBy("partition", BLOCK).agg(F.max("v").alias("v"))
    folder = f"{upload.path}/_manifest/upload={upload.upload_id}"
    files.join(newest, ["partition", BLOCK, "v"]).select(files.columns).write.mode("overwrite").parquet(folder)
    written = spark.read.schema(MANIFEST_SCHEMA).parquet(folder)
    record = (
        upload.upload_id,
        upload.overwrite,
        upload.partition,
        row_schema.json(),
        json.dumps(upload.partition_by),
    )
    (
        spark.createDataFrame([record], COMMIT_SCHEMA)
        .coalesce(1)
        .write.mode("errorifexists")
        .json(f"{upload.path}/_commits/version={version}")
    )
    return written.withColumn("version", F.lit(version))


# -- reading --------------------------------------------------------------


def live_files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Manifest rows that are part of the table at ``version`` (default: newest)."""
    path = path.rstrip("/")
    log = [r for r in _commits(spark, path) if version is None or r["version"] <= version]
    return _live(spark, path, log)


def _live(spark: SparkSession, path: str, log: list[Row]) -> DataFrame:
    rows = _manifest(spark, path, log)
    # The last overwrite of the table, and of each partition, hides what is older.
    whole = max((r["version"] for r in log if r["overwrite"] and r["partition"] is None), default=1)
    scopes = [(r["partition"], r["version"]) for r in log if r["overwrite"] and r["partition"] is not None]
    kept = rows.where(F.col("version") >= whole)
    if not scopes:
        return kept
    replaced = spark.createDataFrame(scopes, "scope string, at int").groupBy("scope").agg(
        F.max("at").alias("replaced_at")
    )
    kept = kept.join(replaced, F.col("partition") == F.col("scope"), "left")
    return kept.where(F.col("version") >= F.coalesce("replaced_at", F.lit(1))).select(*rows.columns)


def read_session(
    spark: SparkSession, path: str, partition: str | None = None, version: int | None = None
) -> DataFrame:
    """One row that describes a read of a published table, pinned to a version.

    ``(table, version, partition, record_count, raw_size, columns, status)``.  The
    counts come from the manifest, so no data is read.
    """
    path = path.rstrip("/")
    log = [r for r in _commits(spark, path) if version is None or r["version"] <= version]
    if not log:
        raise ValueError(f"nothing is published at {path}")
    files = _live(spark, path, log)
    row_schema = T.StructType.fromJson(json.loads(log[-1]["row_schema"]))
    keys = json.loads(log[-1]["partition_by"])
    if partition is not None:
        if list(partition_values(partition)) != keys:
            raise ValueError("the partition spec must name every partition column, in order")
        files = files.where(F.col("partition") == _canonical_partition(partition))
    declared = [c for c in declared_columns(row_schema) if c.name != BLOCK]
    text = schema_json([c for c in declared if c.name not in keys], [c for c in declared if c.name in keys])
    return files.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("record_count"),
        F.coalesce(F.sum("raw_size"), F.lit(0)).alias("raw_size"),
    ).select(
        F.lit(path).alias("table"),
        F.lit(log[-1]["version"]).alias("version"),
        F.lit(partition).cast("string").alias("partition"),
        "record_count",
        "raw_size",
        F.lit(text).alias("columns"),
        F.lit("normal").alias("status"),
    )


def published_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a table at a version.

    The folder of all blocks is read as one partitioned table and kept to the files
    that the manifest names, so no list of files or folders goes through the driver's
    code; the upload and attempt of a file are partition columns, which the
    join prunes by.
    """
    path = path.rstrip("/")
    log = [r for r in _commits(spark, path) if version is None or r["version"] <= version]
    if not log:
        raise ValueError(f"nothing is published at {path}")
    last = log[-1]
    row_schema = T.StructType.fromJson(json.loads(last["row_schema"]))
    partition_by = json.loads(last["partition_by"])
    columns = [c for c in row_schema.fieldNames() if c != BLOCK]

    live = _live(spark, path, log).select(
        "upload_id", "v", F.concat_ws("/", "dir", "file_name").alias("_file")
    )
    if live.isEmpty():
        return spark.createDataFrame([], T.StructType([row_schema[c] for c in columns]))
    stored = T.StructType(
        [f for f in row_schema.fields if f.name not in partition_by and f.name != BLOCK]
        + [T.StructField("upload_id", T.StringType()), T.StructField("v", T.IntegerType())]
        + [T.StructField(c, row_schema[c].dataType) for c in partition_by]
        + [T.StructField(BLOCK, T.LongType())]
    )
    own = F.substring_index(_decoded(F.col("_metadata.file_path")), "/_blocks/", -1)
    rows = spark.read.schema(stored).parquet(f"{path}/_blocks").withColumn("_file", own)
    return rows.join(live, ["upload_id", "v", "_file"], "left_semi").select(*columns)
