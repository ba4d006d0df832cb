import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablewire.llm import packing
from tablewire.llm.shared import settle
from tablewire.llm.tokens import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def fill(histogram, capacity):
    plan = packing._Plan.of(packing.pack_histogram(histogram, capacity))
    length = np.repeat(list(histogram), list(histogram.values()))
    rank = np.concatenate([np.arange(n) for n in histogram.values()]) if histogram else np.zeros(0, int)
    sequence, offset = plan.places(length, rank)
    bins = {}
    for s, o, size in zip(sequence.tolist(), offset.tolist(), length.tolist()):
        bins.setdefault(s, []).append((o, size))
    for parts in bins.values():
        at = 0
        for o, size in sorted(parts):
            assert o == at
            at += size
        assert at <= capacity
    return len(bins)


def fewest(items, capacity):
    """The least number of sequences, by search over all placements."""
    items = sorted(items, reverse=True)
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i, room in enumerate(bins):
            if room >= items[k] and room not in bins[:i]:
                place(k + 1, bins[:i] + [room - items[k]] + bins[i + 1 :])
        place(k + 1, bins + [capacity - items[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(60))
def test_plan_places_every_piece_and_is_near_the_least(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 31])
    items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
    histogram = {s: items.count(s) for s in set(items)}
    found, least = fill(histogram, capacity), fewest(items, capacity)
    assert least <= found <= least + 1


@pytest.mark.parametrize("seed", range(60))
def test_fixed_sets_lose_no_optimum(seed):
    rng = random.Random(1000 + seed)
    capacity = 20
    items = [rng.randint(1, capacity) for _ in range(9)]
    counts = {s: items.count(s) for s in set(items)}
    fixed = sum(times for _, times in packing._dominating_sets(counts, capacity))
    rest = [s for s, n in counts.items() for _ in range(n)]
    assert fixed + fewest(rest, capacity) == fewest(items, capacity)


def test_many_pieces_reach_the_bound():
    rng = random.Random(3)
    items = [min(2048, int(rng.lognormvariate(6, 1))) or 1 for _ in range(50_000)]
    histogram = {s: items.count(s) for s in set(items)}
    runs = packing.pack_histogram(histogram, 2048)
    assert len(runs) < 64 * 2048
    assert fill(histogram, 2048) <= -(-sum(items) // 2048) * 1.002


def test_small_pieces_share_a_run():
    assert fill({1: 100_000}, 2048) == -(-100_000 // 2048)
    assert fill({2048: 5}, 2048) == 5
    assert fill({}, 2048) == 0
    with pytest.raises(ValueError):
        packing.pack_histogram({0: 1}, 8)


def test_tokenizer_cache_gives_the_ids_of_the_library():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(5)
    letters = "abz AZ09 .,'`-\n\t 　\x1c\x1fé́ßΣσ😀<|endoftext|>"
    texts = ["", " ", "it's we'd 'S", "<|endoftext|> a<|startoftext|>b", "é ́e", "a\x1cb c"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(800)]
    for cached in (5, 100_000):
        own = WordTokenizer(PATH, cached)
        for at in range(0, len(texts), 100):
            part = texts[at : at + 100]
            ids, places = own.encode(pa.array(part))
            for text, a, b in zip(part, places, places[1:]):
                assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_documents_of_every_kind(spark, docs_of, odd_rows):
    library = Tokenizer.from_file(PATH)
    pieces = settle(packing.token_pieces(docs_of(odd_rows), PATH, 0, 2048, keep_ids=True), "test")
    rows = packing.pack_pieces(pieces, 2048).collect()
    got = sorted((r.key is None, r.key or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    expected = []
    for key, text, _ in odd_rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at : at + 2048]
            expected.append((key is None, key or 0, n, at, len(own), zlib.crc32(own.tobytes())))
    assert got == sorted(expected)
    whole = {r.sequence_id: r for r in packing.sequences(packing.pack_pieces(pieces, 2048)).collect()}
    for r in rows:
        own = np.frombuffer(whole[r.sequence_id].ids, "<u4")[r.offset : r.offset + r.length]
        assert own.tobytes() == r.ids
    assert sum(r.n_tokens for r in whole.values()) == sum(r.length for r in rows)


def test_empty_table(docs_of):
    assert packing.pack_documents(docs_of([]), PATH).collect() == []
