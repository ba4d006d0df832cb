import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewire.llm import hmm

WORDS = hmm.SYMBOLS


def model_of(seed, states=3, symbols=6):
    rng = np.random.default_rng(seed)
    emit, moves = rng.random((symbols, states)) + 0.05, rng.random((states, states)) + 0.05
    start = rng.random(states)
    return hmm.Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emit / emit.sum(0))


def by_paths(sequence, begin, model):
    """Probability and expected counts as sums over all paths of states."""
    import itertools

    states = len(begin)
    total, emit = 0.0, np.zeros_like(model.emit)
    moves, starts = np.zeros_like(model.moves), np.zeros(states)
    for path in itertools.product(range(states), repeat=len(sequence)):
        p = begin[path[0]] * model.emit[sequence[0], path[0]]
        for a, b, symbol in zip(path, path[1:], sequence[1:]):
            p *= model.moves[a, b] * model.emit[symbol, b]
        total += p
        starts[path[0]] += p
        for s, symbol in zip(path, sequence):
            emit[symbol, s] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
    return total, emit / total, moves / total, starts / total


@pytest.mark.parametrize("seed", range(5))
def test_recursions_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    model = model_of(seed)
    sequences = [rng.integers(0, 6, n).astype(np.uint16) for n in (1, 6, 3, 5, 1, 4)]
    logs = hmm.log_likelihoods(sequences, model)
    for sequence, log in zip(sequences, logs):
        assert math.isclose(log, math.log(by_paths(sequence, model.start, model)[0]), rel_tol=1e-9)
    counts = hmm.expected_counts(hmm._Rows(sequences), model)
    emit, moves, starts = (sum(w[n] for w in [by_paths(s, model.start, model) for s in sequences]) for n in (1, 2, 3))
    np.testing.assert_allclose(counts, np.concatenate([emit.ravel(), moves.ravel(), starts]), rtol=1e-8, atol=1e-10)


@pytest.mark.parametrize("segment,segments", [(1, 2), (2, 3), (3, 256), (6, 1), (7, 4)])
def test_borders_of_segments_change_no_count(monkeypatch, segment, segments):
    monkeypatch.setattr(hmm, "SEGMENT", segment)
    monkeypatch.setattr(hmm, "SEGMENTS", segments)
    rng, model = np.random.default_rng(8), model_of(5)
    for n in (1, 2, 6, 7):
        sequence = rng.integers(0, 6, n).astype(np.uint16)
        _, *want = by_paths(sequence, model.start, model)
        np.testing.assert_allclose(hmm.long_counts(sequence, model), np.concatenate([w.ravel() for w in want]), rtol=1e-8, atol=1e-10)
    long = rng.integers(0, 6, 3000).astype(np.uint16)
    np.testing.assert_allclose(hmm.long_counts(long, model), hmm.expected_counts(hmm._Rows([long]), model), rtol=1e-8, atol=1e-8)


def test_very_long_texts_train_like_others(docs_of, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.choice([3, 40, 200]))), "s") for i in range(30)]

    def scores():
        got = hmm.score(docs_of(rows), F.col("doc_id") % 5 == 1, states=3, rounds=3).collect()
        return [s for _, s in sorted((r.key, r.score) for r in got)]

    whole = scores()
    monkeypatch.setattr(hmm, "LONG_TEXT", 30)
    monkeypatch.setattr(hmm, "SEGMENT", 11)
    np.testing.assert_allclose(scores(), whole, rtol=1e-9)


def test_long_texts_by_transfer_matrices(monkeypatch):
    rng, model = np.random.default_rng(1), model_of(7)
    long = rng.integers(0, 6, 3000).astype(np.uint16)
    plain = hmm.log_likelihoods([long], model)[0]
    monkeypatch.setattr(hmm, "LONG_TEXT", 100)
    for segment in (7, 64, 5000):
        monkeypatch.setattr(hmm, "SEGMENT", segment)
        assert math.isclose(hmm.log_likelihoods([long], model)[0], plain, rel_tol=1e-10)


def test_a_round_never_lowers_the_likelihood():
    rng, model, totals = np.random.default_rng(3), hmm.Model.first(np.full(20, 1e6), 3), np.zeros(20)
    sequences = [(rng.integers(0, 10, 60) + 10 * (k % 2)).astype(np.uint16) for k in range(30)]
    before = -np.inf
    for _ in range(6):
        now = hmm.log_likelihoods(sequences, model).sum()
        assert now > before - 0.5  # the small share of the overall distribution moves it a little
        before = now
        model = hmm.Model.from_counts(hmm.expected_counts(hmm._Rows(sequences), model), totals, 3)
    assert before > -30 * 60 * math.log(20) * 0.85


def tokens(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split() if w] + [None]


@pytest.mark.parametrize("head,own", [(hmm.HEAD, hmm.OWN), (5, 3)])
def test_scores(spark, docs_of, monkeypatch, head, own):
    monkeypatch.setattr(hmm, "HEAD", head)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["Aa", "b", f"c{rng.randrange(30)}", f"D{rng.randrange(9)}"]) for _ in range(rng.randrange(25))), "s") for i in range(80)]
    rows += [(100, None, "s"), (101, "", "s"), (102, "never seen before", "s"), (5, rows[5][1], "s"), (None, "aa b", "s")]
    held = lambda key: key is not None and key % 4 == 1
    got = hmm.score(docs_of(rows), F.coalesce(F.col("doc_id") % 4 == 1, F.lit(False)), states=2, rounds=2).collect()
    counts = Counter(w for k, t, _ in rows if not held(k) for w in tokens(t))
    n, kinds = sum(counts.values()), len(counts)
    want = sorted(
        (k is None, k or 0, held(k), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
         round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in tokens(t)), 6))
        for k, t, _ in rows
    )
    assert sorted((r.key is None, r.key or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    same = [round(r.score, 9) for r in got if r.key == 5]
    assert len(same) == 2 and same[0] == same[1]


def test_probabilities_sum_to_one(spark, docs_of):
    """Over all texts of one word, known or not, that share a symbol: their words' shares and the unseen one add up."""
    rows = [(i, f"word{i % 7} other{i % 3}", "s") for i in range(40)]
    counts = hmm.word_counts(docs_of(rows).select("text"))
    known = hmm.vocabulary(counts, 40)
    assert known.tokens == 120 and known.distinct == 11
    shares = 10 ** (np.log10(known.counts + 0.5) - known.denominators()[known.symbols])
    for symbol in set(known.symbols[known.symbols >= hmm.OWN].tolist()):
        mine = shares[known.symbols == symbol].sum() + 0.5 * 10 ** -known.denominators()[symbol]
        assert math.isclose(mine, 1.0)


def test_no_rows(docs_of):
    assert hmm.score(docs_of([]), F.lit(False), rounds=1).collect() == []
    none = hmm.score(docs_of([(1, "a b", "s")]), F.lit(True), rounds=1).collect()
    assert none[0].train_tokens == 0 and none[0].n_known == 0 and none[0].base_score == 0 and math.isfinite(none[0].score)
