import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewire.llm.shared import bounded_slices, text_bytes, word_hashes, word_spans

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbB \t\n\x0b\x0c\réß😀."), max_size=40)), max_size=8)


def lower(data):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    found, names = [], {}
    for k in range(len(texts)):
        words = [lower(data[a:b].tobytes()) for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]])]
        found.append(words)
        for word, h in zip(words, hashes[first[k] : first[k + 1]].tolist()):
            assert names.setdefault(word, h) == h
    assert found == [WORD.findall(lower((t or "").encode())) for t in texts]
    assert len(set(names.values())) == len(names)


def test_long_words_and_slices():
    texts = ["ab" * 400 + " x", None, "ab" * 400, "y" * 300, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(bounded_slices(batch, "text", 500))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    data, offsets = text_bytes(batch.slice(2).column("text"))
    starts, ends, _ = word_spans(data, offsets)
    whole, whole_offsets = text_bytes(batch.column("text"))
    a, b, _ = word_spans(whole, whole_offsets)
    assert word_hashes(data, starts, ends)[0] == word_hashes(whole, a, b)[0]
    assert len(np.unique(word_hashes(whole, a, b))) == 3
