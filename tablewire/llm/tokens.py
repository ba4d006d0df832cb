"""Token ids of texts by a public tokenizer file, computed once per distinct word.

The tokenizer drops white space and never joins across it, nor across the border
between letters and digits or signs, so the ids of a text are those of its words in
order, and those of a word of plain letters and signs are those of its runs of
each. ``units`` finds words and runs in arrays and hashes them; a Python worker
keeps their ids in a table of 64-bit hashes. Only units that are not in it cost
calls: runs of ASCII letters go to the library's model, all others to the library
together, with a special token between them, which never is a part of one. Two
units would have to share a hash to be taken for each other: for a table of
200,000 units the chance is one in 10^14 per new one.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from tablewire.llm.shared import text_bytes, word_hashes, word_spans, worker_cache

#: Words whose ids a worker keeps; beyond that it goes on with those that came in most slices.
CACHED_WORDS = 200_000
#: Words that go to the library in one text.
TOGETHER = 512

# fixed values: the settings under which words can be encoded apart
_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_STEPS = ["NFC", "Replace", "Lowercase"]


_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
#: Bytes with which a word stays whole: beyond ASCII, an apostrophe (contractions), a beginning of special tokens, odd spaces.
_WHOLE = np.arange(256) >= 128
_WHOLE[[ord("'"), ord("<"), *range(0x1C, 0x20)]] = True
_LATIN = 0xC3  #: lead byte of U+00C0 to U+00FF, all letters but two
_NO_LETTERS = (0x97, 0xB7)


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the units of all texts, and per text the first unit's number."""
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64), first
    letter, whole = _LETTER[data], _WHOLE[data]
    lead = np.flatnonzero(data[:-1] == _LATIN)
    lead = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] <= 0xBF) & ~np.isin(data[lead + 1], _NO_LETTERS)]
    for place in (lead, lead + 1):
        letter[place], whole[place] = True, False
    # a combining mark may change the sign or letter before it: words with one hold a byte that keeps them whole
    kept = np.concatenate(([0], np.cumsum(whole)))
    plain = kept[ends] == kept[starts]
    turns = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    word = np.searchsorted(starts, turns, "right") - 1
    turns = turns[(word >= 0) & plain[word] & (turns > starts[word]) & (turns < ends[word])]
    begin, end = np.sort(np.concatenate([starts, turns])), np.sort(np.concatenate([ends, turns]))
    h = word_hashes(data, begin, end)  # without case, as the tokenizer has it
    signs = np.concatenate(([0], np.cumsum(data == ord("<"))))
    exact = np.flatnonzero(signs[end] != signs[begin])  # but for special tokens
    h[exact] = word_hashes(data, begin[exact], end[exact], fold=False) ^ np.uint64(0x9E3779B97F4A7C15)
    h[h == 0] = 1
    return begin, end, h, np.searchsorted(begin, offsets)


class _WordTable:
    """Ids by word hash: open addressing over arrays of a power of two; 0 marks a free place."""

    def __init__(self, room: int):
        size = 1 << max(10, (2 * room - 1).bit_length())
        self.hashes = np.zeros(size, np.uint64)
        self.starts = np.zeros(size, np.int64)
        self.counts = np.zeros(size, np.int64)
        self.uses = np.zeros(size, np.int32)  #: slices that held the word
        self.ids = np.zeros(1 << 12, np.uint32)
        self.used, self.words, self._mask = 0, 0, np.uint64(size - 1)

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash its place, or the free one where it would go, and whether it is there."""
        at = (h & self._mask).astype(np.int64)
        own = self.hashes[at]
        there = own == h
        wrong = np.flatnonzero(~there & (own != 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & int(self._mask)
            own = self.hashes[at[wrong]]
            there[wrong] = own == h[wrong]
            wrong = wrong[(own != h[wrong]) & (own != 0)]
        return at, there

    def add(self, h: np.ndarray, ids: np.ndarray, sizes: np.ndarray, uses: np.ndarray | int = 0) -> None:
        """Adds words that are not there yet; ``ids`` has their ids one after another."""
        end = self.used + len(ids)
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(end, np.uint32)])
        self.ids[self.used : end] = ids
        starts, uses = self.used + np.cumsum(sizes) - sizes, np.broadcast_to(uses, len(h))
        left = np.arange(len(h))
        while len(left):  # of several words for one free place the first gets it
            at, _ = self.places(h[left])
            _, first = np.unique(at, return_index=True)
            own, at = left[first], at[first]
            self.hashes[at], self.starts[at], self.counts[at], self.uses[at] = h[own], starts[own], sizes[own], uses[own]
            left = np.delete(left, first)
        self.used, self.words = end, self.words + len(h)

    def ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at some places, one after another, and n + 1 offsets."""
        counts = self.counts[at]
        total = np.concatenate(([0], np.cumsum(counts)))
        return self.ids[np.repeat(self.starts[at] - total[:-1], counts) + np.arange(total[-1])], total


class WordTokenizer:
    """``encode(column)`` gives the ids of all texts of a column and each text's place among them."""

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._cached = cached
        self._table = _WordTable(cached)
        rules = json.loads(self._library.to_str())
        steps = rules.get("normalizer") or {}
        split = ((rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        whole = [t for t in rules.get("added_tokens") or [] if not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])]
        self._between = (whole[0]["content"].encode(), whole[0]["id"]) if whole else None
        self._specials = [t["content"].encode() for t in rules.get("added_tokens") or []]
        self._drops_space = (
            [s.get("type") for s in steps.get("normalizers", [])] == _STEPS
            and split.get("pattern", {}).get("Regex") == _PIECES
            and self._between is not None
        )

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and n + 1 offsets into them; a null text is empty."""
        if not self._drops_space:
            ids = self._whole([t or "" for t in column.to_pylist()])
            sizes = np.array([len(i) for i in ids], np.int64)
            return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.concatenate(([0], np.cumsum(sizes)))
        data, offsets = text_bytes(column)
        starts, ends, h, first = units(data, offsets)
        at, there = self._table.places(h)
        self._table.uses[at] += 1
        if not there.all():
            gone = np.flatnonzero(~there)
            new, example = np.unique(h[gone], return_index=True)
            if self._table.words + len(new) > self._cached:
                self._renew(h[there], len(new))
            example = gone[example]
            raw = data.tobytes()
            words = [raw[a:b] for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True)]
            self._table.add(new, *self._learn(words), uses=1)
            at, _ = self._table.places(h)
        ids, total = self._table.ids_at(at)
        return ids, total[first]

    def _renew(self, needed: np.ndarray, more: int) -> None:
        """A table of the words needed now and those that came in most slices, with room for ``more``."""
        old, least = self._table, 2
        while (old.uses >= least).sum() > self._cached // 2:
            least *= 2
        kept = np.union1d(old.hashes[(old.uses >= least) & (old.hashes != 0)], needed)
        at, _ = old.places(kept)
        self._table = _WordTable(max(self._cached, len(kept) + more))
        self._table.add(kept, old.ids_at(at)[0], old.counts[at], old.uses[at] // 2)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, np.uint32) for e in found]

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units, one after another, and the number of each."""
        tokenize = self._library.model.tokenize
        letters = [w.isalpha() for w in words]  # of bytes: ASCII letters alone
        own = [[t.id for t in tokenize(w.decode().lower())] for w, plain in zip(words, letters, strict=True) if plain]
        ids, sizes = self._joined([w for w, plain in zip(words, letters, strict=True) if not plain])
        letters = np.array(letters, bool)
        every = np.zeros(len(words), np.int64)
        every[letters], every[~letters] = [len(i) for i in own], sizes
        flat = np.zeros(int(every.sum()), np.uint32)
        of_letters = np.repeat(letters, every)
        flat[of_letters] = [i for one in own for i in one]
        flat[~of_letters] = ids
        return flat, every

    def _joined(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        mark, number = self._between
        parts = [words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        ids, sizes = [], []
        for part, found in zip(parts, self._whole([mark.join(p).decode() for p in parts]), strict=True):
            ends = np.append(np.flatnonzero(found == number), len(found))
            joint = b"\n".join(part)
            if len(ends) == len(part) and not any(s in joint for s in self._specials):
                ids.append(found[found != number])
                sizes.append(np.diff(ends, prepend=-1) - 1)
            else:  # a word holds a special token itself
                alone = self._whole([w.decode() for w in part])
                ids += alone
                sizes.append(np.array([len(i) for i in alone]))
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)


def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's own tokenizer for a file, kept between tasks."""
    return worker_cache("tokenizer:" + path, lambda: WordTokenizer(path))
