"""Near-duplicates by circulant MinHash (operator 6).

A text's set holds the distinct shingles of ``words`` words. One permutation
scatters the shingles over a ring, a second one gives every place of the ring a
rank, and coordinate k of the signature is the smallest rank after a shift by k:
two permutations give all coordinates. Bands of the signature are hashed to
buckets.

A bucket is never expanded into all pairs. Texts with equal sets are one node.
First every node of a bucket is compared with the smallest node there (a star:
as many pairs as nodes). Where the signatures agree enough, the exact sets are
compared, and confirmed links form components. A pair of a bucket that this left
undecided has its nodes in different components: those outside of the centre's
component are compared with the whole bucket in tiles of bounded size, by signature
and then on their sets. A pair is looked at in the first bucket that it shares, a
tile joins components as it goes, and only links that join two of them come out.

What is probable rather than certain is that a pair at the threshold shares a
bucket: bands are as many as it takes for all but 5 in ten million to do so, 25 of 5
at a similarity of 0.85 and 37 at 0.80. The signature test keeps pairs from 5.5
standard deviations below the mean at the threshold on: 84 of 125 equal coordinates
at 0.85, 118 of 185 at 0.80.

Defined cases: a text without words has an empty set, is linked with nothing and
is kept; rows sharing an id count as one document; rows whose id is null take
their component from a text with an equal set, or have none and are kept; ties
go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewire.llm.components import connected_components
from tablewire.llm.shared import (
    arrow_batch, arrow_type, bounded_slices, mix, settle, tasks_for, text_bytes, word_hashes, word_spans, worker_cache,
)

#: Coordinates of a band.
ROWS = 5
#: Chance at most that a pair at the threshold shares no bucket.
MISS = 5e-7
#: Standard deviations below the mean at the threshold that the signature test lets pass.
DEVIATIONS = 5.5
#: Percentages that bands and signature test are derived for; above the last one they are those of the last one.
PERCENTS = (80, 85)
#: Places of the ring.
RING = 1 << 22
#: Nodes outside of the centre's component, and nodes of the bucket, in one tile.
TILE_OUT, TILE_ALL = 512, 1024

SIGNED = "key long, n_shingles long, digest binary, bands array<long>, signature binary"
SETS = "node long, digest binary, shingles binary"
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Layout(NamedTuple):
    """Bands, coordinates of a signature, and equal ones from which on a pair is confirmed on its sets."""

    bands: int
    size: int
    agree: int


def layout_of(percent: int) -> Layout:
    low, high = PERCENTS
    if percent < low:
        raise ValueError(f"bands and signature test are derived for {low} percent or more")
    p = min(percent, high) / 100
    bands = math.ceil(math.log(MISS) / math.log1p(-(p**ROWS)))
    size = bands * ROWS
    return Layout(bands, size, math.floor(size * p - DEVIATIONS * math.sqrt(size * p * (1 - p))))


def shingle_sets(texts: pa.Array, words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(texts)
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    n = len(h) - words + 1
    run = np.full(max(n, 0), np.uint64(words))
    for k in range(words):
        run = mix(run * _ODD + h[k : k + len(run)])
    out, first = [], first.tolist()
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= words:
            out.append(np.unique(run[a : b - words + 1]))
        elif b > a:
            own = np.full(1, np.uint64(b - a))
            for k in range(a, b):
                own = mix(own * _ODD + h[k : k + 1])
            out.append(own)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _rings(size: int = layout_of(85).size) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the shifted views of the ranking one."""
    random = np.random.Generator(np.random.PCG64(20_240_229))
    scatter = random.permutation(RING).astype(np.int32)
    ranks = random.permutation(RING).astype(np.uint32)
    ring = np.concatenate([ranks, ranks[: size - 1]])
    return scatter, np.lib.stride_tricks.sliding_window_view(ring, size)


def signature(shingles: np.ndarray, rings: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    scatter, shifts = rings
    places = scatter[(shingles >> np.uint64(64 - (RING.bit_length() - 1))).astype(np.int64)]
    low = np.full(shifts.shape[1], 0xFFFFFFFF, np.uint32)
    for at in range(0, len(places), 2048):
        low = np.minimum(low, shifts[places[at : at + 2048]].min(0))
    return low


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit number per band that also tells the band."""
    rows = signatures.reshape(len(signatures), -1, ROWS).astype(np.uint64)
    run = np.broadcast_to(np.arange(rows.shape[1], dtype=np.uint64), rows.shape[:2])
    for k in range(ROWS):
        run = mix(run * _ODD + rows[:, :, k])
    return run.view(np.int64)


def signed(docs: DataFrame, words: int, size: int, text: str, key: str) -> DataFrame:
    """Size, digest, band hashes and signature bytes of every text's set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rings = arrow_type(SIGNED), worker_cache(f"circulant-rings-{size}", lambda: _rings(size))
        for batch in batches:
            for part in bounded_slices(batch, "text"):
                sets = shingle_sets(part.column("text"), words)
                found = np.array([signature(s, rings) for s in sets], np.uint32).reshape(-1, size)
                columns = [
                    part.column("key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array(band_hashes(found).tolist(), pa.list_(pa.int64())),
                    pa.array([s.tobytes() for s in found.astype(np.uint8)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(sign, SIGNED)


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 85, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` per row of ``docs``.

    Two texts are linked where 100 x |intersection| >= ``percent`` x |union|; a
    component is what links connect, and ``kept`` marks its smallest id.
    """
    layout = layout_of(percent)
    every = settle(signed(docs, words, layout.size, text, key), "signed")
    nodes = settle(
        every.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("key").alias("node"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
        .where("node IS NOT NULL"),
        "nodes",
    )
    members = settle(_stars(nodes), "members")
    signatures = nodes.select("node", "signature")
    close = settle(_agreeing(members.select("node", "center").distinct(), signatures, layout), "close")
    crowded = members.where("n > 2")
    wanted = (
        close.select(F.explode(F.array("a", "b")).alias("node"))
        .unionByName(crowded.select("node"))
        .unionByName(crowded.select(F.col("center").alias("node")))
        .distinct()
    )
    sets = settle(_sets_of(docs, settle(wanted, "wanted"), words, text, key), "sets")
    links = settle(_confirmed(close, sets, percent), "links")
    parts = connected_components(links)
    more = settle(_undecided(crowded, parts, nodes, sets, percent, layout), "links")
    if not more.isEmpty():
        parts = connected_components(links.unionByName(more))
    named = nodes.select("digest", "node").join(parts, "node", "left")
    named = settle(named.select("digest", F.coalesce("component", "node").alias("component_id")), "named")
    out = every.select("key", "n_shingles", "digest").join(named, "digest", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("key"))
    return out.select(
        "key", "n_shingles", own.alias("component_id"), F.coalesce(F.col("key") == own, own.isNull()).alias("kept")
    )


def _stars(nodes: DataFrame) -> DataFrame:
    """``(band, node, center, n)``: the nodes of each bucket of ``n`` with its smallest one."""
    dealt = nodes.select(F.explode("bands").alias("band"), "node")
    buckets = settle(dealt.groupBy("band").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1"), "buckets")
    return dealt.join(buckets, "band").where("node <> center")


def _agreeing(pairs: DataFrame, signatures: DataFrame, layout: Layout) -> DataFrame:
    """``(a, b)`` of ``pairs(node, center)`` whose signatures agree enough."""
    left = signatures.withColumnRenamed("signature", "sa")
    right = signatures.select(F.col("node").alias("center"), F.col("signature").alias("sb"))
    out = "a long, b long"
    _, size, least = layout

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(out)
        for batch in batches:
            a, b = (_rows(batch.column(c), size) for c in ("sa", "sb"))
            kept = pa.array((a == b).sum(1) >= least)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").filter(kept), batch.column("center").filter(kept)], schema=schema
            )

    return pairs.join(left, "node").join(right, "center").select("node", "center", "sa", "sb").mapInArrow(agree, out)


def _rows(column: pa.Array, size: int) -> np.ndarray:
    data, _ = text_bytes(column.cast(pa.binary()))
    return data.reshape(-1, size)


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int, text: str, key: str) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, given = arrow_type(SETS), set()
        for batch in batches:
            for part in bounded_slices(batch, "text"):
                rows = []
                for node, found in zip(part.column("node").to_pylist(), shingle_sets(part.column("text"), words), strict=True):
                    own = found.tobytes()
                    digest = hashlib.blake2b(own, digest_size=16).digest()
                    if (node, digest) not in given:
                        given.add((node, digest))
                        rows.append((node, digest, own))
                yield arrow_batch(rows, schema)

    texts = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).join(wanted, "node")
    sets = texts.select("node", "text").mapInArrow(build, SETS)
    # repeated rows: one set per node and content, first in the task, then over all tasks
    return sets.groupBy("node", "digest").agg(F.first("shingles").alias("shingles")).drop("digest")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose exact sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    out = "a long, b long"

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(out)
        for batch in batches:
            rows = [
                (a.as_py(), b.as_py())
                for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "left", "right")), strict=True)
                if _similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
            ]
            yield arrow_batch(rows, schema)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(confirm, out).distinct()


def _undecided(
    members: DataFrame, parts: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, layout: Layout
) -> DataFrame:
    """Links between nodes that share a bucket but no component yet, the centre's own pairs left out."""
    of_node = parts.select("node", F.col("component").alias("own"))
    of_center = parts.select(F.col("node").alias("center"), F.col("component").alias("main"))
    split = settle(
        members.join(of_node, "node", "left")
        .join(of_center, "center", "left")
        .select("band", "node", F.coalesce("own", "node").alias("own"), F.coalesce("main", "center").alias("main")),
        "split",
    )
    outer = (F.col("own") != F.col("main")).cast("long")
    sizes = settle(
        split.groupBy("band").agg(F.count("*").alias("n"), F.sum(outer).alias("n_out")).where("n > 1 AND n_out > 0"),
        "tiles",
    )
    sized = split.join(sizes, "band")
    tiles_out = F.ceil(F.col("n_out") / TILE_OUT).cast("int")
    tiles_all = F.ceil(F.col("n") / TILE_ALL).cast("int")
    spread = F.xxhash64("node", "band")
    rows = sized.select(
        "band", "node", "own", (outer > 0).alias("out"),
        F.pmod(spread, tiles_out).cast("int").alias("i"), F.pmod(spread, tiles_all).cast("int").alias("j"),
        tiles_out.alias("tiles_out"), tiles_all.alias("tiles_all"),
    )
    whole = rows.select(
        "band", F.explode(F.expr("sequence(0, tiles_out - 1)")).alias("i"), "j", "node", "own", F.lit(1).alias("side")
    )
    outside = rows.where("out").select(
        "band", "i", F.explode(F.expr("sequence(0, tiles_all - 1)")).alias("j"), "node", "own", F.lit(0).alias("side")
    )
    tiles = (
        outside.unionByName(whole)
        .join(nodes.select("node", "signature", "bands"), "node")
        .join(sets, "node")
        .repartition(tasks_for(members.sparkSession), "band", "i", "j")
        .sortWithinPartitions("band", "i", "j", "side")
    )
    out = "a long, b long"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rest = arrow_type(out), None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([rest, batch] if rest is not None else [batch]).combine_chunks()
            table = table.to_batches()[0]
            ends = _group_ends(table)
            for a, b in zip([0, *ends[:-1]], ends, strict=False):
                if b < table.num_rows:
                    yield _tile_links(table.slice(a, b - a), percent, layout, schema)
            last = ends[-2] if len(ends) > 1 else 0
            rest = table.slice(last)
        if rest is not None:
            yield _tile_links(rest, percent, layout, schema)

    return tiles.mapInArrow(compare, out).distinct()


def _group_ends(table: pa.RecordBatch) -> list[int]:
    """Ends of the runs of equal (band, i, j)."""
    columns = [table.column(c).to_numpy(zero_copy_only=False) for c in ("band", "i", "j")]
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return [*(np.flatnonzero(change) + 1).tolist(), table.num_rows]


def _tile_links(tile: pa.RecordBatch, percent: int, layout: Layout, schema: pa.Schema) -> pa.RecordBatch:
    """Links that join components, from the nodes outside (first) to all nodes of the tile."""
    n_out = int((tile.column("side").to_numpy() == 0).sum())
    node, root = tile.column("node").to_numpy(), tile.column("own").to_numpy().copy()
    bits = _rows(tile.column("signature"), layout.size)
    bands = tile.column("bands").flatten().to_numpy().reshape(-1, layout.bands)
    here = bands[0].tolist().index(tile.column("band")[0].as_py())
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in tile.column("shingles")]
    links = []
    for k in range(n_out):
        other = np.flatnonzero(root[n_out:] != root[k]) + n_out
        other = other[(bits[other] == bits[k]).sum(1) >= layout.agree]
        for m in other[(bands[other] == bands[k]).argmax(1) == here].tolist():
            if root[m] != root[k] and _similar(sets[k], sets[m], percent):
                links.append((int(max(node[k], node[m])), int(min(node[k], node[m]))))
                root[root == root[m]] = root[k]
    return arrow_batch(links, schema)
