"""Byte-level BPE encoding and decoding by a rank file (operator 9).

A text is split by the pattern; each match is merged apart. The bytes of a match
are the leaves of a segment tree whose nodes hold the leftmost smallest rank of
the pairs below, so its root names the next merge. A merge changes three pairs:
the merged one, the one that began at its right half, and the one of its live
left neighbour; each is a point update along one path of the tree. Matches of
similar length are worked on together, one row of an array each; a long match
uses a tree of its own in plain lists.

A worker encodes a word once and keeps its ids for a while. Words are cut at
single spaces between visible characters, where no match of the pattern spans.

Defined cases: a null text counts as empty and has no ids; a text of any length
and any characters decodes to its own bytes; equal rows give equal results; an
empty table gives no rows; ids outside of the table are an error on decoding.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewire.llm.shared import arrow_type, bounded_slices, worker_cache

#: Words whose ids a worker keeps; beyond that it starts anew with those in use.
CACHED_WORDS = 200_000
#: Matches of more bytes have a tree of their own.
LONG_MATCH = 128
#: Matches that are merged together.
BATCH = 4096

# fixed value: the characters that Unicode calls white space
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str, cached: int = CACHED_WORDS):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}
        self._cached, self._ranks, self._words = cached, ranks, {}
        # white space as Unicode has it, in and outside of sets
        whole = regex.sub(r"\[\^\\s", lambda _: "[^" + _WHITE, pattern).replace("\\s", f"[{_WHITE}]")
        self._match = regex.compile(whole.replace("\\S", f"[^{_WHITE}]"))
        self._edge = regex.compile(f"^[{_WHITE}]|[{_WHITE}]$")
        self._rare = regex.compile(f"^[{_WHITE}]|[{_WHITE}]$|[{_WHITE}][{_WHITE}]|\\x00")
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        self._pair_rank = dict(pairs)
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self._pairs, self._merged = table[:, 0].copy(), table[:, 1].copy()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        lists = [self._words_of(text) for text in texts]
        needed: set[str] = set().union(*lists)
        missing = list(needed - self._words.keys())
        if len(self._words) + len(missing) > self._cached:
            self._words = {w: self._words[w] for w in needed.difference(missing)}
        self._learn(missing)
        ids = self._words.__getitem__
        return [b"".join(map(ids, words)) for words in lists]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _words_of(self, text: str) -> list[str]:
        """Parts that no match spans: split before each space that stands alone between visible characters."""
        if not text:
            return []
        if not self._rare.search(text):
            return text.replace(" ", "\0 ").split("\0")
        first, *rest = text.split(" ")
        words, edge, whole = [first], self._edge.search, bool(first) and not self._edge.search(first)
        for word in rest:
            clear = bool(word) and not edge(word)
            if whole and clear:
                words.append(" " + word)
            else:
                words[-1] += " " + word
            whole = clear
        return words

    def _learn(self, words: list[str]) -> None:
        split = self._match.findall  # one run of letters after a space is one match
        found = [
            [word.encode()] if word[0] == " " and word[1:].isalpha() else [m.encode() for m in split(word)]
            for word in words
        ]
        known: dict[bytes, bytes] = {}
        open_: dict[int, list[bytes]] = {}
        for match in {m for matches in found for m in matches}:
            rank = self._ranks.get(match)
            if rank is not None:
                known[match] = rank.to_bytes(4, "little")
            elif len(match) > LONG_MATCH:
                known[match] = np.array(self._merge_long(match), "<u4").tobytes()
            else:
                open_.setdefault(max(2, 1 << (len(match) - 1).bit_length()), []).append(match)
        for width, matches in open_.items():
            for at in range(0, len(matches), BATCH):
                part = matches[at : at + BATCH]
                known.update(zip(part, self._merge(part, width), strict=True))
        for word, matches in zip(words, found, strict=True):
            self._words[word] = b"".join(map(known.__getitem__, matches))

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair in the upper half of a number, all ones where there is none."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        return np.where(self._pairs[at] == pair, self._merged[at].astype(np.uint64) << np.uint64(32), _NONE)

    def _merge(self, matches: list[bytes], width: int) -> list[bytes]:
        """Merges of matches of at most ``width`` bytes, a power of two; row by row of one array."""
        n = len(matches)
        length = np.fromiter(map(len, matches), np.int64, n)
        raw = np.frombuffer(b"".join(m.ljust(width, b"\0") for m in matches), np.uint8).reshape(n, width)
        ids = np.zeros((n, width + 1), np.int64)
        ids[:, :width] = self._byte[raw]
        place = np.arange(width + 1)
        following = np.repeat(place[None, 1:], n, 0)  # live neighbour to the right; ``length`` is the end
        before = np.repeat(place[None, :] - 1, n, 0)  # and to the left; -1 is the start
        tree = np.full((n, 2 * width), _NONE, np.uint64)
        pair = self._ranks_of(ids[:, : width - 1], ids[:, 1:width])
        inside = (place[None, 1:width] < length[:, None]) & (pair != _NONE)
        leaves = tree[:, width:]
        leaves[:, : width - 1] = np.where(inside, pair | place[None, : width - 1].astype(np.uint64), _NONE)
        half = width
        while half > 1:
            half //= 2
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
        alive = np.ones((n, width + 1), bool)

        def update(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = value
            while len(rows) and node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            rows, root = rows[root != _NONE], root[root != _NONE]
            if not len(rows):
                break
            at, rank = (root & _LOW).astype(np.int64), (root >> np.uint64(32)).astype(np.int64)
            right = following[rows, at]
            beyond = following[rows, right]
            ids[rows, at], following[rows, at], before[rows, beyond], alive[rows, right] = rank, beyond, at, False
            update(rows, right, np.full(len(rows), _NONE))
            value = self._ranks_of(rank, ids[rows, beyond])
            update(rows, at, np.where((beyond < length[rows]) & (value != _NONE), value | at.astype(np.uint64), _NONE))
            left = before[rows, at]
            inner, left, own = rows[left >= 0], left[left >= 0], rank[left >= 0]
            value = self._ranks_of(ids[inner, left], own)
            update(inner, left, np.where(value != _NONE, value | left.astype(np.uint64), _NONE))
        alive &= place[None, :] < length[:, None]
        flat, counts = ids[alive].astype("<u4"), alive.sum(1)
        ends = np.cumsum(counts) * 4
        flat = flat.tobytes()
        return [flat[e - 4 * c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]

    def _merge_long(self, match: bytes) -> list[int]:
        """Merges of one long match, with the same tree in lists."""
        n, rank_of, none = len(match), self._pair_rank.get, (1 << 64) - 1
        width = 1 << (n - 1).bit_length()
        ids = self._byte[np.frombuffer(match, np.uint8)].tolist()
        following, before = list(range(1, n + 1)), list(range(-1, n))

        def pair(at: int, right: int) -> int:
            rank = rank_of(ids[at] << 32 | ids[right]) if right < n else None
            return none if rank is None else rank << 32 | at

        tree = [none] * (2 * width)
        tree[width : width + n - 1] = [pair(i, i + 1) for i in range(n - 1)]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            while node > 1:
                node >>= 1
                value = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == value:
                    break
                tree[node] = value

        while tree[1] != none:
            rank, at = tree[1] >> 32, tree[1] & 0xFFFFFFFF
            right = following[at]
            beyond = following[right]
            ids[at], following[at], before[beyond] = rank, beyond, at
            update(right, none)
            update(at, pair(at, beyond))
            if before[at] >= 0:
                update(before[at], pair(before[at], at))
        out, at = [], 0
        while at < n:
            out.append(ids[at])
            at = following[at]
        return out


def _codec(path: str, pattern: str) -> ByteBpe:
    return worker_cache(f"bytebpe:{path}:{pattern}", lambda: ByteBpe(path, pattern))


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, ids)``: ids as little-endian 32-bit numbers in a binary column."""
    return _coded(docs, ranks, pattern, text, key, False)


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, ids, decoded)``: ``decoded`` are the bytes that the ids stand for."""
    return _coded(docs, ranks, pattern, text, key, True)


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``(key, decoded)`` from the result of ``encode``."""
    out = "key long, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, codec = arrow_type(out), _codec(ranks, pattern)
        for batch in batches:
            decoded = [codec.decode(ids or b"") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(decoded, pa.binary())], schema=schema)

    return encoded.select("key", "ids").mapInArrow(run, out)


def _coded(docs: DataFrame, ranks: str, pattern: str, text: str, key: str, back: bool) -> DataFrame:
    out = "key long, ids binary" + (", decoded binary" if back else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, codec = arrow_type(out), _codec(ranks, pattern)
        for batch in batches:
            for part in bounded_slices(batch, "text"):
                ids = codec.encode([t or "" for t in part.column("text").to_pylist()])
                columns = [part.column("key"), pa.array(ids, pa.binary())]
                if back:
                    columns.append(pa.array([codec.decode(i) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, out)
