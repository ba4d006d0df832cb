import io
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewire.llm import records

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture
def written(docs_of, odd_rows, tmp_path):
    return records.write_records(docs_of(odd_rows), PATH, 2, base=str(tmp_path / "set"), n_files=3)


def test_round_trip_in_key_order(spark, written, odd_rows):
    rows = records.read_records(spark, written).orderBy("part", "place").collect()
    expected = sorted((k is not None, k or 0, zlib.crc32(np.array(ids_of(t), "<u4").tobytes())) for k, t, _ in odd_rows)
    assert sorted((r.key is not None, r.key or 0, zlib.crc32(r.ids)) for r in rows) == expected
    assert [(r.key is not None, r.key or 0) for r in rows] == [e[:2] for e in expected]
    start = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (start, len(r.ids) // 4)
        start += r.n_tokens


def test_shuffled_reads_follow_the_index(spark, written, odd_rows):
    index = written.index_table(spark)
    found = records.read_at(index.orderBy(F.xxhash64("offset", "part"))).collect()
    expected = sorted((k is not None, k or 0, np.array(ids_of(t), "<u4").tobytes()) for k, t, _ in odd_rows)
    assert sorted((r.key is not None, r.key or 0, r.ids) for r in found) == expected


def test_files_without_an_index_row_are_not_read(spark, written, odd_rows):
    path = index_files(spark, written)[0]
    with open(path, "rb") as a, open(os.path.join(os.path.dirname(path), "part-000000-left.rec"), "wb") as b:
        b.write(a.read())
    assert records.read_records(spark, written).count() == len(odd_rows)


def index_files(spark, written):
    return [r.file for r in written.index_table(spark).select("file").distinct().collect()]


@pytest.mark.parametrize("at", [3, 13, 17, 25, -2])
def test_damage_is_found(spark, written, at):
    path = index_files(spark, written)[0]
    with open(path, "r+b") as f:
        f.seek(at, 0 if at >= 0 else 2)
        byte = f.read(1)
        f.seek(-1, 1)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="damaged|not a record file"):
        records.read_records(spark, written).collect()


def test_frames():
    data = io.BytesIO(records.header(2) + records.frame(b"") + records.frame(b"abc"))
    assert records.read_header(data) == 2
    assert [records.read_record(data) for _ in range(3)] == [b"", b"abc", None]
    with pytest.raises(records.BrokenRecord):
        records.read_record(io.BytesIO(records.frame(b"abc")[:-1]))


def test_ids_that_do_not_fit_are_an_error(docs_of, tmp_path):
    with pytest.raises(Exception, match="needs more than 1 bytes"):
        records.write_records(docs_of([(1, "many words here", "a")]), PATH, 2, base=str(tmp_path / "x"), width=1)


def test_empty_table(spark, docs_of, tmp_path):
    empty = records.write_records(docs_of([]), PATH, 2, base=str(tmp_path / "none"))
    assert records.read_records(spark, empty).collect() == []
