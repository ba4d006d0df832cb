"""A stream written as committed blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewire.operators.blocks import BLOCK
from tablewire.plans.publish import commit_upload, create_upload, is_committed, stage_blocks


def stream_to_blocks(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Start a query that commits each micro-batch as one block of ``path``.

    The upload is named by query and batch, so a batch that is replayed after a
    failure finds its own commit and is skipped; what it staged before failing is
    overwritten or stays invisible.  No exchange is added.
    """
    row_schema = T.StructType([*stream.schema.fields, T.StructField(BLOCK, T.LongType())])

    def write_epoch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        upload = create_upload(path, upload_id=f"{query}.{epoch}")
        if is_committed(spark, path, upload.upload_id):
            return
        rows = batch.withColumn(BLOCK, F.lit(epoch).cast("long"))
        stage_blocks(rows, upload, rebalance=False, check=False)
        commit_upload(spark, upload, row_schema)

    writer = stream.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
