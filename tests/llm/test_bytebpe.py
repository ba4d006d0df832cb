import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tablewire.llm import bytebpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("cached", [3, 100_000])
def test_ids_are_those_of_the_library(library, cached):
    rng = random.Random(cached)
    letters = "abcdefgh  \n\t\x1c\x1f\x85　é😀'sT1290.,-́ßΣ\r\0"
    texts = ["", " ", "  ", "a" * 3000, "ab" * 700 + " x", " " * 300, "it's 'll  we'd\n\n x ", "a\x1cb \x1c \x1dc", "\0 \0", "é" * 200]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 150))) for _ in range(1500)]
    codec = bytebpe.ByteBpe(PATH, public_tokenizers.PATTERN, cached)
    for at in range(0, len(texts), 200):
        part = texts[at : at + 200]
        for text, ids in zip(part, codec.encode(part)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text
            assert codec.decode(ids) == text.encode()


def test_both_trees_agree():
    codec = bytebpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    rng = random.Random(2)
    for width in (2, 4, 16, 64, 128):
        matches = [bytes(rng.choice(b"aabetn \xc3\xa9") for _ in range(rng.randint(width // 2 + 1, width))) for _ in range(200)]
        for match, ids in zip(matches, codec._merge(matches, width)):
            assert np.frombuffer(ids, "<u4").tolist() == codec._merge_long(match)


def test_documents_of_every_kind(docs_of, odd_rows, library):
    docs = docs_of(odd_rows)
    rows = bytebpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    expected = sorted((k is None, k or 0, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t, _ in odd_rows)
    assert sorted((r.key is None, r.key or 0, bytes(r.ids), bytes(r.decoded)) for r in rows) == expected
    apart = bytebpe.decode(bytebpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.key is None, r.key or 0, bytes(r.decoded)) for r in apart) == sorted((a, b, d) for a, b, _, d in expected)
    assert bytebpe.encode(docs_of([]), PATH, public_tokenizers.PATTERN).collect() == []
