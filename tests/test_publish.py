import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewire.operators.blocks import BLOCK, assign_blocks
from tablewire.plans import publish


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def numbers(spark, low, high):
    return spark.range(low, high).select("id", (F.col("id") % 3).cast("string").alias("p"), F.lit("x").alias("t"))


def with_block(df):
    return T.StructType([*df.schema.fields, T.StructField(BLOCK, T.LongType())])


def write(spark, path, df, **how):
    upload = publish.create_upload(path, **how)
    publish.stage_blocks(assign_blocks(df, ["id"], 4, hashed=False), upload)
    return publish.commit_upload(spark, upload, with_block(df))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_staged_rows_are_invisible_before_the_commit(spark, path):
    write(spark, path, numbers(spark, 0, 10))
    upload = publish.create_upload(path)
    publish.stage_blocks(assign_blocks(numbers(spark, 10, 20), ["id"], 4, hashed=False), upload)
    assert ids(publish.published_table(spark, path)) == list(range(10))
    publish.commit_upload(spark, upload, with_block(numbers(spark, 0, 1)))
    assert ids(publish.published_table(spark, path)) == list(range(20))


def test_nothing_published(spark, path):
    with pytest.raises(ValueError):
        publish.published_table(spark, path)
    assert publish.current_version(spark, path) == 0


def test_append_overwrite_and_old_versions(spark, path):
    write(spark, path, numbers(spark, 0, 5))
    write(spark, path, numbers(spark, 5, 9))
    write(spark, path, numbers(spark, 20, 22), overwrite=True)
    write(spark, path, numbers(spark, 30, 31))
    assert publish.current_version(spark, path) == 4
    assert ids(publish.published_table(spark, path)) == [20, 21, 30]
    assert ids(publish.published_table(spark, path, 2)) == list(range(9))
    assert ids(publish.published_table(spark, path, 3)) == [20, 21]


def test_partition_overwrite(spark, path):
    how = {"partition_by": ["p"]}
    write(spark, path, numbers(spark, 0, 9), **how)
    write(spark, path, numbers(spark, 100, 109).where("p = '1'"), overwrite=True, partition="p='1'", **how)
    write(spark, path, numbers(spark, 200, 203), **how)
    rows = publish.published_table(spark, path)
    assert rows.columns == ["id", "p", "t"] and dict(rows.dtypes)["p"] == "string"
    assert ids(rows) == [0, 2, 3, 5, 6, 8, 100, 103, 106, 200, 201, 202]
    assert ids(publish.published_table(spark, path, 1)) == list(range(9))


def test_overwrite_of_another_partition_is_refused(spark, path):
    with pytest.raises(ValueError):
        write(spark, path, numbers(spark, 0, 9), overwrite=True, partition="p=1", partition_by=["p"])
    with pytest.raises(ValueError):
        publish.create_upload(path, partition="q=1", partition_by=["p"])


def test_block_sent_again_replaces_the_older_one(spark, path):
    upload = publish.create_upload(path)
    cut = assign_blocks(numbers(spark, 0, 12), ["id"], 4, hashed=False)
    publish.stage_blocks(cut, upload, attempt=0)
    publish.stage_blocks(cut.where("block_id = 2").withColumn("t", F.lit("again")), upload, attempt=1)
    files = publish.commit_upload(spark, upload, with_block(numbers(spark, 0, 1)))
    assert {(r["block_id"], r["v"]) for r in files.collect()} == {(0, 0), (1, 0), (2, 1), (3, 0)}
    rows = publish.published_table(spark, path).collect()
    assert sorted(r["id"] for r in rows) == list(range(12))
    assert {r["id"] for r in rows if r["t"] == "again"} == {2, 6, 10}


def test_manifest_counts_every_file(spark, path):
    df = numbers(spark, 0, 100)
    files = write(spark, path, df).collect()
    assert sum(r["record_count"] for r in files) == 100
    assert sum(r["raw_size"] for r in files) == 100 * (8 + 1 + 1)
    assert all(r["file_name"].endswith(".parquet") and r["version"] == 1 for r in files)


def test_upload_without_blocks(spark, path):
    upload = publish.create_upload(path)
    files = publish.commit_upload(spark, upload, with_block(numbers(spark, 0, 1)))
    assert files.count() == 0
    assert publish.published_table(spark, path).count() == 0


def test_an_upload_commits_once(spark, path):
    upload = publish.create_upload(path)
    df = numbers(spark, 0, 3)
    cut = assign_blocks(df, ["id"], 2, hashed=False)
    publish.stage_blocks(cut, upload)
    publish.commit_upload(spark, upload, with_block(df))
    with pytest.raises(ValueError):
        publish.commit_upload(spark, upload, with_block(df))
    with pytest.raises(ValueError):
        publish.stage_blocks(cut, upload)


def test_a_failing_row_fails_the_job_and_publishes_nothing(spark, path):
    write(spark, path, numbers(spark, 0, 3))
    upload = publish.create_upload(path, max_field_size=3)
    long = assign_blocks(numbers(spark, 3, 6).withColumn("t", F.lit("toolong")), ["id"], 2, hashed=False)
    with pytest.raises(Exception, match="field over the size limit: t"):
        publish.stage_blocks(long, upload)
    assert ids(publish.published_table(spark, path)) == [0, 1, 2]


def test_special_characters_in_partitions(spark, path):
    df = spark.createDataFrame([(1, "a b+c:d%"), (2, "é/x")], "id long, p string")
    write(spark, path, df, partition_by=["p"])
    write(spark, path, df.where("id = 1").withColumn("id", F.lit(9).cast("long")), partition_by=["p"])
    got = sorted((r["id"], r["p"]) for r in publish.published_table(spark, path).collect())
    assert got == [(1, "a b+c:d%"), (2, "é/x"), (9, "a b+c:d%")]


def test_a_hot_block_is_split_over_files(spark, path):
    # Far smaller sizes than in use, so that the hot block needs several tasks.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20kb")
    try:
        rows = spark.range(0, 60000, 1, 6).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
        hot = rows.withColumn(BLOCK, F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 8).cast("int"))
        upload = publish.create_upload(path)
        publish.stage_blocks(hot, upload)
        files = publish.commit_upload(spark, upload, with_block(rows)).where("block_id = 0")
        assert files.count() > 1
        assert files.agg(F.max("record_count")).first()[0] < 30000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_commit_reads_only_the_row_sizes(spark, path, plan):
    upload = publish.create_upload(path)
    publish.stage_blocks(assign_blocks(numbers(spark, 0, 9), ["id"], 2, hashed=False), upload)
    text = plan(publish._staged_files(spark, upload))
    assert "ReadSchema: struct<_row_bytes:bigint>" in text


def test_describe(spark, path):
    upload = publish.create_upload(path, overwrite=True, max_field_size=10)
    row = upload.describe(spark, numbers(spark, 0, 1).schema).first()
    assert row["is_overwrite"] and row["max_field_size"] == 10 and row["status"] == "normal"


def test_overwrite_of_a_partition_with_special_characters(spark, path):
    df = spark.createDataFrame([(1, "a b+c:d%"), (2, "é")], "id long, p string")
    write(spark, path, df, partition_by=["p"])
    newer = df.where("id = 1").withColumn("id", F.lit(7).cast("long"))
    write(spark, path, newer, overwrite=True, partition="p='a b+c:d%'", partition_by=["p"])
    assert ids(publish.published_table(spark, path)) == [2, 7]


def test_read_session_counts_from_the_manifest(spark, path, plan):
    how = {"partition_by": ["p"]}
    write(spark, path, numbers(spark, 0, 9), **how)
    write(spark, path, numbers(spark, 9, 12), **how)
    session = publish.read_session(spark, path)
    assert (session.first()["record_count"], session.first()["version"]) == (12, 2)
    assert publish.read_session(spark, path, "p=1").first()["record_count"] == 4
    assert publish.read_session(spark, path, "p=1", version=1).first()["record_count"] == 3
    assert "_blocks" not in plan(session)
    with pytest.raises(ValueError):
        publish.read_session(spark, path, "q=1")


def test_a_refused_commit_leaves_the_first_one_whole(spark, path, monkeypatch):
    first, second, small = publish.create_upload(path), publish.create_upload(path), numbers(spark, 90, 93)
    publish.stage_blocks(assign_blocks(numbers(spark, 0, 10), ["id"], 2, hashed=False), first)
    publish.stage_blocks(assign_blocks(small, ["id"], 2, hashed=False), second)
    stale = publish._commits(spark, path)
    publish.commit_upload(spark, first, with_block(small))
    monkeypatch.setattr(publish, "_commits", lambda *_: stale)
    with pytest.raises(Exception, match="(?i)already exists"):
        publish.commit_upload(spark, second, with_block(small))
    monkeypatch.undo()
    assert ids(publish.published_table(spark, path)) == list(range(10))


def test_rows_without_a_block_key_are_published(spark, path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (7, "c")], "id long, t string")
    write(spark, path, df)
    assert sorted(r["t"] for r in publish.published_table(spark, path).collect()) == ["a", "b", "c"]


def test_files_that_no_manifest_names_are_not_read(spark, path):
    df = numbers(spark, 0, 10)
    upload = publish.create_upload(path)
    cut = assign_blocks(df, ["id"], 2, hashed=False)
    publish.stage_blocks(cut, upload)
    publish.commit_upload(spark, upload, with_block(df))
    cut.withColumn(publish.ROW_BYTES, F.lit(1).cast("long")).write.mode("append").partitionBy(BLOCK).parquet(
        f"{path}/_blocks/upload_id={upload.upload_id}/v=0"
    )
    assert ids(publish.published_table(spark, path)) == list(range(10))


def test_a_block_sent_again_for_one_partition_leaves_the_others(spark, path):
    df = numbers(spark, 0, 10).withColumn("p", (F.col("id") % 2).cast("int"))
    upload = publish.create_upload(path, partition_by=["p"])
    publish.stage_blocks(assign_blocks(df, ["id"], 1, hashed=False), upload)
    again = df.where("p = 1").withColumn("id", F.col("id") + 100)
    publish.stage_blocks(assign_blocks(again, ["id"], 1, hashed=False), upload, attempt=1)
    publish.commit_upload(spark, upload, with_block(df))
    assert ids(publish.published_table(spark, path)) == [0, 2, 4, 6, 8, 101, 103, 105, 107, 109]
