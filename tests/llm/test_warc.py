import base64
import gzip
import hashlib
import io
import random

import pytest

from tablewire.llm import warc
from tablewire.scratch import shared_dir

PAGES = "page_id long, url string, html string, key string, shard int, digest string, winner string, _tie long"


@pytest.fixture(scope="module")
def pages_of(spark):
    return lambda rows: spark.createDataFrame([(*r, "k", 1, "d", "w", 5) for r in rows], PAGES).repartition(3)


def digest_of(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def checked(rows, found, least=0):
    """Every row has its record, and equal payloads have one response with the largest id."""
    got = [(r["key"], r["payload_bytes"], r["payload_digest"]) for r in found]
    assert sorted(got, key=repr) == sorted(((k, len((h or "").encode()), digest_of(h)) for k, _, h in rows), key=repr)
    groups = {}
    for k, _, h in rows:
        groups.setdefault(h or "", []).append(-1 if k is None else k)
    top = {digest_of(h): max(keys) for h, keys in groups.items()}
    small = {digest_of(h) for h in groups if len(h.encode()) < least}
    for r in found:
        last = top[r["payload_digest"]]
        if r["record_type"] == "response":
            assert r["refers_to"] is None and (r["payload_digest"] in small or (-1 if r["key"] is None else r["key"]) == last)
        else:
            assert r["payload_digest"] not in small and r["refers_to"] == (None if last == -1 else last)
    responses = [r["payload_digest"] for r in found if r["record_type"] == "response" and r["payload_digest"] not in small]
    assert sorted(responses) == sorted({d for d in top if d not in small})


ODD = [
    (1, "http://a/", "<p>x</p>"), (1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u", ""), (None, "u", "only without id"),
    (None, None, "only without id"), (None, "v", "<p>x</p>"), (9, "bad\r\nWARC-Type: metadata\x00ü", "é😀\r\n\r\nWARC/1.1\r\n"),
    (10, "u", "long " * 300_000), (10, "u", "other text, same id"), (11, "w", "\x1f\x8b gzip-like"),
]


@pytest.mark.parametrize("least", [0, 9])
def test_odd_rows(spark, pages_of, least):
    archive = warc.write_archive(pages_of(ODD), revisit_bytes=least, shard_bytes=400_000, roll_bytes=2_000)
    checked(ODD, warc.read_archive(spark, archive).collect(), least)


def test_order_rolling_and_same_bytes(spark, pages_of):
    rng = random.Random(3)
    rows = [(k, f"http://h/{k}", "".join(rng.choices("abcdef \n", k=rng.randint(0, 3_000)))) for k in range(400)]
    rows += [(k + 1000, "copy", rows[7][2]) for k in range(200)] + [rows[9]] * 300
    stored = shared_dir(spark, "pages-in")
    pages_of(rows).write.parquet(stored)
    found, sums = [], []
    for parts in (1, 8):
        spark.conf.set("spark.sql.files.minPartitionNum", str(parts))
        archive = warc.write_archive(spark.read.parquet(stored), shard_bytes=150_000, roll_bytes=20_000)
        manifest = archive.manifest_table(spark).orderBy("file").collect()
        sums.append([(r["file"].rsplit("/", 1)[1], r["sha256"], r["n_records"]) for r in manifest])
        found.append(warc.read_archive(spark, archive).collect())
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert sums[0] == sums[1] and len({r["shard"] for r in manifest}) > 4 and len(manifest) > len({r["shard"] for r in manifest})
    checked(rows, found[0])
    ordered = sorted(found[0], key=lambda r: (r["file"].rsplit("/", 1)[1], r["offset"]))
    keys = [r["key"] for r in ordered]
    assert keys == sorted(keys)
    hot = [r["shard"] for r in found[0] if r["key"] == rows[9][0]]
    assert len(hot) == 301 and len(set(hot)) > 1


def test_files_are_plain_gzip_and_damage_is_found(spark, pages_of):
    archive = warc.write_archive(pages_of([(k, "u", f"page {k} " * 50) for k in range(30)]))
    (row,) = archive.manifest_table(spark).collect()
    with open(row["file"].removeprefix("file:"), "rb") as stream:
        data = stream.read()
    assert len(data) == row["n_bytes"] and hashlib.sha256(data).hexdigest() == row["sha256"]
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == row["n_records"] == 31
    _, record = list(warc.read_members(io.BytesIO(data)))[3]
    warc.parse_record(record)
    with pytest.raises(warc.BrokenArchive):
        warc.parse_record(record.replace(b"page 2 ", b"pagf 2 ", 1))
    with open(row["file"].removeprefix("file:"), "wb") as stream:
        stream.write(data[: len(data) // 2])
    with pytest.raises(Exception, match="ends within a record|records, its manifest"):
        warc.read_archive(spark, archive).collect()


def test_empty_table(spark, pages_of):
    archive = warc.write_archive(pages_of([(1, "u", "x")]).limit(0))
    assert archive.manifest_table(spark).count() == 0 and warc.read_archive(spark, archive).count() == 0
