"""Language-model scoring with a hidden Markov model (operator 7).

Tokens are the lower-cased words of a text and one end. The most frequent words
are symbols of their own; other words share a symbol by their last letters, and
within it each word has its own smoothed probability, so the model gives every text
a probability. Baum-Welch trains the latent states: each task runs the scaled
forward and backward recursions over its training sequences, the expected counts
are added up in two steps, of tasks and then of parameters, and only those sums, whose
number is fixed by the model, reach the driver. Training and scoring take whole texts;
very long ones go segment by segment, with the states at every border carried over by
transfer matrices, so that a border changes no count and no probability.

Word counts are a distributed table. Its most frequent ``HEAD`` words are sent
to every task (a fixed size); rarer words of each text are joined with the table.
A word is identified by a 64-bit hash.

Defined cases: a null text counts as empty, its only token is the end; unseen words
have the probability of a count of zero; equal rows score alike; with no training
rows the base score follows the formula with zero counts, and the model is uniform;
null ids are scored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewire.llm.shared import (
    arrow_batch, arrow_type, bounded_slices, mix, plain, settle, tasks_for, text_bytes, word_hashes, word_spans,
)

#: Words whose counts every task gets.
HEAD = 1 << 18
#: Words that are symbols of their own, and symbols by last letters.
OWN, SHARED = 4_095, 512
#: Symbols: own words, shared ones, and the end.
SYMBOLS = OWN + SHARED + 1
END = SYMBOLS - 1
STATES = 8
ROUNDS = 8
#: Tokens of a segment of a very long text, segments at a time, and tokens from which on a text is very long.
SEGMENT, SEGMENTS = 512, 256
LONG_TEXT = 16_384
#: Tokens that are scored or trained on together.
TOKENS = 1 << 21

COUNTED = "word long, shared int, n long"
CODED = (
    "uid long, key long, train boolean, n_tokens long, known long, head_log double, own_log double, "
    "symbols binary, tail binary"
)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, symbols by last letters, and the first word's number of each text."""
    data, offsets = text_bytes(texts)
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    code = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3):
        at = ends - back
        byte = np.where(at >= starts, data[np.maximum(at, 0)] if len(data) else 0, 0).astype(np.uint64)
        upper = (byte >= 65) & (byte <= 90)
        code = code << np.uint64(8) | np.where(upper, byte + np.uint64(32), byte)
    return h, (mix(code) % np.uint64(SHARED)).astype(np.int32), first


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, shared, n)`` over a ``text`` column: counts are summed per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(COUNTED)
        seen = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in batches:
            for part in bounded_slices(batch, "text", 4 << 20):
                h, shared, _ = _tokens(part.column("text"))
                seen = _summed(np.concatenate([seen[0], h]), np.concatenate([seen[1], shared]), np.concatenate([seen[2], np.ones(len(h), np.int64)]))
                if len(seen[0]) > 1 << 20:
                    yield _counted(seen, schema)
                    seen = tuple(s[:0] for s in seen)
        yield _counted(seen, schema)

    return texts.select("text").mapInArrow(count, COUNTED).groupBy("word").agg(F.max("shared").alias("shared"), F.sum("n").alias("n"))


def _summed(h: np.ndarray, shared: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, at, back = np.unique(h, return_index=True, return_inverse=True)
    return words, shared[at], np.bincount(back, n, len(words)).astype(np.int64)


def _counted(seen: tuple, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(seen[0].view(np.int64)), pa.array(seen[1]), pa.array(seen[2])], schema=schema)


@dataclass(frozen=True)
class Vocabulary:
    """Bounded statistics of the word counts."""

    words: np.ndarray  #: hashes of the head words, sorted
    counts: np.ndarray
    symbols: np.ndarray  #: symbol of each head word; those from OWN on are shared
    totals: np.ndarray  #: tokens of each symbol
    kinds: np.ndarray  #: distinct words of each symbol
    tokens: int
    distinct: int
    ends: int

    def denominators(self) -> np.ndarray:
        """log10 of what the counts within a shared symbol are divided by; 0 for the others."""
        out = np.log10(self.totals + 0.5 * (self.kinds + 1))
        out[:OWN], out[END] = 0.0, 0.0
        return out


def _least_count(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` words reach, from a histogram with 16 steps per doubling."""
    step = F.floor(F.log2("n") * 16)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n"), F.max("n").alias("top")).collect()
    least = 1 + max((r["top"] for r in steps), default=0)
    for row in sorted(steps, key=lambda r: -r["step"]):  # 1,024 rows at most
        most -= row["words"]
        if most < 0:
            break
        least = row["n"]
    return least


def vocabulary(counts: DataFrame, n_texts: int) -> Vocabulary:
    """From a settled table of word counts and the number of training texts."""
    least = _least_count(counts, HEAD)
    head = counts.where(F.col("n") >= least).select("word", "shared", "n").toPandas()  # HEAD rows at most
    head = head.sort_values(["n", "word"], ascending=[False, True])
    sums = counts.groupBy("shared").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()  # SHARED rows
    words = head["word"].to_numpy(np.int64).view(np.uint64)
    n, shared = head["n"].to_numpy(np.int64), head["shared"].to_numpy(np.int64)
    symbols = shared + OWN
    symbols[:OWN] = np.arange(min(OWN, len(words)))
    totals, kinds = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for row in sums:
        totals[OWN + row["shared"]], kinds[OWN + row["shared"]] = row["n"], row["kinds"]
    totals -= np.bincount(shared[:OWN] + OWN, n[:OWN], SYMBOLS)
    kinds -= np.bincount(shared[:OWN] + OWN, minlength=SYMBOLS)
    totals[: len(n[:OWN])], kinds[: len(n[:OWN])] = n[:OWN], 1
    totals[END], kinds[END] = n_texts, 1
    order = np.argsort(words)
    return Vocabulary(
        words[order], n[order], symbols[order].astype(np.uint16), totals, kinds,
        int(sum(r["n"] for r in sums)) + n_texts, int(sum(r["kinds"] for r in sums)) + (n_texts > 0), n_texts,
    )


def coded(texts: DataFrame, known: Vocabulary) -> DataFrame:
    """Each text of ``texts(key, train, text)`` as symbols, with the sums that need head words only."""
    shared = texts.sparkSession.sparkContext.broadcast(plain(known))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known, uid = arrow_type(CODED), Vocabulary(*shared.value), TaskContext.get().partitionId() << 40
        logs, below = np.log10(known.counts + 0.5), known.denominators()
        end_log = math.log10(known.ends + 0.5)
        for batch in batches:
            for part in bounded_slices(batch, "text"):
                h, last, first = _tokens(part.column("text"))
                at = np.minimum(np.searchsorted(known.words, h), max(len(known.words) - 1, 0))
                is_head = known.words[at] == h if len(known.words) else np.zeros(len(h), bool)
                symbol = (last + OWN).astype(np.uint16)
                log = np.zeros(len(h))
                symbol[is_head], log[is_head] = known.symbols[at[is_head]], logs[at[is_head]]
                own = np.where(symbol >= OWN, log, 0.0) - below[symbol]
                tail = h.view(np.int64).copy()
                rows = []
                keys, train = part.column("key").to_pylist(), part.column("train").to_pylist()
                heads = np.concatenate([[0], np.cumsum(is_head)])[first]
                for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    mine = np.append(symbol[a:b], np.uint16(END))
                    rare = tail[a:b][~is_head[a:b]]
                    rows.append((
                        uid, keys[k], train[k], b - a + 1, int(heads[k + 1] - heads[k]) + (known.ends > 0),
                        float(log[a:b].sum()) + end_log, float(own[a:b].sum()), mine.tobytes(), rare.tobytes(),
                    ))
                    uid += 1
                yield arrow_batch(rows, schema)

    return texts.mapInArrow(code, CODED)


def rare_sums(table: DataFrame, counts: DataFrame) -> DataFrame:
    """``(uid, rare_log, rare_known)`` for the texts of a coded table that hold words beyond the head."""
    out = "uid long, word long, times long"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(out)
        for batch in batches:
            tails = [np.frombuffer(t.as_buffer(), np.int64) for t in batch.column("tail")]
            for a in range(0, len(tails), 512):
                part = [np.unique(t, return_counts=True) for t in tails[a : a + 512]]
                uid = np.repeat(batch.column("uid").to_numpy()[a : a + 512], [len(w) for w, _ in part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid), pa.array(np.concatenate([w for w, _ in part])), pa.array(np.concatenate([n for _, n in part]).astype(np.int64))],
                    schema=schema,
                )

    words = table.where("octet_length(tail) > 0").select("uid", "tail").mapInArrow(spread, out)
    n = F.coalesce("n", F.lit(0))
    joined = words.join(counts.select("word", "n"), "word", "left")
    return joined.groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("rare_log"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )


@dataclass(frozen=True)
class Model:
    start: np.ndarray  #: states of a text's first token
    moves: np.ndarray  #: from state, to state
    emit: np.ndarray  #: symbol, state

    @classmethod
    def first(cls, totals: np.ndarray, states: int, seed: int = 11) -> Model:
        random = np.random.Generator(np.random.PCG64(seed))
        share = (totals + 0.5) / (totals + 0.5).sum()
        emit = share[:, None] * np.exp(random.normal(0, 0.7, (len(totals), states)))
        moves = np.full((states, states), 0.05 / max(states - 1, 1))
        np.fill_diagonal(moves, 0.95 if states > 1 else 1.0)
        flat = np.full(states, 1 / states)
        return cls(flat, moves, emit / emit.sum(0))

    @classmethod
    def from_counts(cls, counts: np.ndarray, totals: np.ndarray, states: int) -> Model:
        """The maximisation step, with a small share of the overall distribution so that nothing is impossible."""
        n = len(totals)
        emit = counts[: n * states].reshape(n, states)
        moves, start = counts[n * states : n * states + states**2].reshape(states, states), counts[-states:] + 0.1
        share = (totals + 0.5) / (totals + 0.5).sum()
        emit, moves = emit + share[:, None], moves + 0.1 / states
        return cls(start / start.sum(), moves / moves.sum(1, keepdims=True), emit / emit.sum(0))


class _Rows:
    """Sequences laid out step by step: at each step the ones that are still running, longest first."""

    def __init__(self, sequences: list[np.ndarray]):
        length = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-length, kind="stable")
        self.length = length[self.order]
        steps = int(self.length[0]) if len(length) else 0
        self.running = np.searchsorted(-self.length, -np.arange(1, steps + 1), side="right")
        self.at = np.concatenate([[0], np.cumsum(self.running)])
        joined = np.concatenate(sequences) if len(sequences) else np.zeros(0, np.uint16)
        begin = (np.cumsum(length) - length)[self.order]
        self.symbols = np.empty(self.at[-1], np.uint16)
        for t, n in enumerate(self.running.tolist()):
            self.symbols[self.at[t] : self.at[t] + n] = joined[begin[:n] + t]


def forward(rows: _Rows, begin: np.ndarray, moves: np.ndarray, emit: np.ndarray, keep: bool) -> tuple:
    """Scaled forward recursion: state shares and scales of every step if kept, else the last shares and log scales."""
    states = moves.shape[0]
    share = np.empty((rows.at[-1], states)) if keep else None
    scale = np.empty(rows.at[-1]) if keep else None
    last, log, ones = np.array(begin, float), np.zeros(len(begin)), np.ones(states)
    at = rows.at.tolist()
    for t, n in enumerate(rows.running.tolist()):
        a, b = at[t], at[t + 1]
        now = share[a:b] if keep else np.empty((n, states))
        if t:
            np.matmul(last[:n], moves, out=now)
        else:
            now[:] = last[:n]
        now *= emit.take(rows.symbols[a:b], 0)
        total = now @ ones  # far quicker than a sum over short rows
        now /= total[:, None]
        if keep:
            scale[a:b] = total
            last = now
        else:
            log[:n] += np.log(total)
            last[:n] = now
    return (share, scale) if keep else (last, log)


def expected_counts(rows: _Rows, model: Model, before: np.ndarray | None = None, behind: np.ndarray | None = None) -> np.ndarray:
    """Expected emissions, moves and starts of one set of sequences.

    ``before`` is the states' shares ahead of each first token, zeros where a text begins; ``behind`` is how likely, up to
    a factor, what follows is from each state of the last token. Without both the sequences are whole texts.
    """
    symbols, states = len(model.emit), model.moves.shape[0]
    before = np.zeros((len(rows.order), states)) if before is None else before[rows.order]
    behind = np.ones((len(rows.order), states)) if behind is None else behind[rows.order]
    begins = ~before.any(1)
    share, scale = forward(rows, np.where(begins[:, None], model.start, before @ model.moves), model.moves, model.emit, True)
    pairs, after, against = np.zeros((states, states)), np.zeros((0, states)), np.ascontiguousarray(model.moves.T)
    at = rows.at.tolist()
    for t in range(len(rows.running) - 1, -1, -1):
        a, b, n = at[t], at[t + 1], len(after)
        back = np.empty((b - a, states))
        if n:
            pairs += share[a : a + n].T @ after
            np.matmul(after, against, out=back[:n])
        if n < b - a:
            back[n:] = behind[n : b - a] / (share[a + n : b] * behind[n : b - a]).sum(1, keepdims=True)
        after = model.emit.take(rows.symbols[a:b], 0)
        after *= back
        after /= scale[a:b, None]
        share[a:b] *= back
    pairs += before.T @ after  # moves into the first tokens
    emit = np.stack([np.bincount(rows.symbols, share[:, s], symbols) for s in range(states)], 1)
    start = share[: len(begins)][begins].sum(0)
    return np.concatenate([emit.ravel(), (pairs * model.moves).ravel(), start])


def _ways(chunks: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """How likely each chunk is from each state before it to each state at its end, up to a factor, and the factor's logarithm."""
    states = model.moves.shape[0]
    rows = _Rows([c for c in chunks for _ in range(states)])
    begin = np.tile(model.moves, (len(chunks), 1))  # one move from each state
    ends, logs = forward(rows, begin[rows.order], model.moves, model.emit, False)
    back = np.empty_like(rows.order)
    back[rows.order] = np.arange(len(rows.order))
    ends, logs = ends[back].reshape(-1, states, states), logs[back].reshape(-1, states)
    top = logs.max(1)
    return ends * np.exp(logs - top[:, None])[:, :, None], top


def long_counts(sequence: np.ndarray, model: Model) -> np.ndarray:
    """The expected counts of one very long text, whose segments get the states at their borders from both sides."""
    pieces = [sequence[a : a + SEGMENT] for a in range(0, len(sequence), SEGMENT)]
    states = model.moves.shape[0]
    ways = np.empty((len(pieces), states, states))  # a hundredth of the text's own recursion
    for a in range(1, len(pieces), SEGMENTS):
        ways[a : a + SEGMENTS] = _ways(pieces[a : a + SEGMENTS], model)[0]
    before, behind = np.zeros((len(pieces), states)), np.ones((len(pieces), states))
    now = forward(_Rows(pieces[:1]), model.start[None], model.moves, model.emit, False)[0][0]
    for j in range(1, len(pieces)):
        before[j] = now
        now = now @ ways[j]
        now /= now.sum()
    for j in range(len(pieces) - 1, 0, -1):
        behind[j - 1] = ways[j] @ behind[j]
        behind[j - 1] /= behind[j - 1].max()
    parts = (slice(a, a + SEGMENTS) for a in range(0, len(pieces), SEGMENTS))
    return sum(expected_counts(_Rows(pieces[p]), model, before[p], behind[p]) for p in parts)


def _together(sequences: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The sequences in groups of like length, so that few steps run over few rows."""
    group, size = [], 0
    for sequence in sorted(sequences, key=len):
        group.append(sequence)
        size += len(sequence)
        if size > TOKENS:
            yield group
            group, size = [], 0
    if group:
        yield group


def train(table: DataFrame, known: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the training rows of a settled coded table."""
    context, model = table.sparkSession.sparkContext, Model.first(known.totals, states)
    sequences, out = table.where("train").select("symbols"), "counts array<double>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column("counts"):
                found = row.values.to_numpy()
                total = found.copy() if total is None else total + found
        if total is not None:
            yield arrow_batch([(total,)], arrow_type(out))

    for _ in range(rounds):
        shared = context.broadcast(plain(model))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model, total = Model(*shared.value), None
            for batch in batches:
                whole = [np.frombuffer(row.as_buffer(), np.uint16) for row in batch.column("symbols")]
                found = [expected_counts(_Rows(group), model) for group in _together([s for s in whole if len(s) <= LONG_TEXT])]
                for counts in [*found, *(long_counts(s, model) for s in whole if len(s) > LONG_TEXT)]:
                    total = counts if total is None else total + counts
            if total is not None:
                yield arrow_batch([(total,)], arrow_type(out))

        sums = (
            sequences.mapInArrow(expect, out)
            .repartition(tasks_for(table.sparkSession))  # a row per input task becomes a row per task at hand
            .mapInArrow(add, out)
            .select(F.posexplode("counts").alias("parameter", "n"))
            .groupBy("parameter")
            .agg(F.sum("n").alias("n"))
            .toPandas()  # one row per parameter of the model
        )
        shared.unpersist()
        if not len(sums):
            return model
        counts = np.zeros(SYMBOLS * states + states**2 + states)
        counts[sums["parameter"].to_numpy()] = sums["n"].to_numpy()
        model = Model.from_counts(counts, known.totals, states)
    return model


def log_likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Natural logarithm of each whole sequence's probability."""
    out, short, size = np.zeros(len(sequences)), [], 0
    for i, sequence in enumerate([*sequences, None]):
        if short and (sequence is None or size > TOKENS):
            rows = _Rows([sequences[k] for k in short])
            _, log = forward(rows, np.tile(model.start, (len(short), 1)), model.moves, model.emit, False)
            out[np.array(short)[rows.order]] = log
            short, size = [], 0
        if sequence is not None and len(sequence) <= LONG_TEXT:
            short.append(i)
            size += len(sequence)
    for i, sequence in enumerate(sequences):
        if len(sequence) > LONG_TEXT:
            out[i] = _long_likelihood(sequence, model)
    return out


def _long_likelihood(sequence: np.ndarray, model: Model) -> float:
    """The same recursion in chunks: each from every state at once, then chunk after chunk."""
    now, log = model.start * model.emit[sequence[0]], 0.0
    log += math.log(now.sum())
    now = now / now.sum()
    rest = sequence[1:]
    for block in range(0, len(rest), SEGMENT * SEGMENTS):  # bounded memory for a text of any length
        chunks = [rest[a : a + SEGMENT] for a in range(block, min(block + SEGMENT * SEGMENTS, len(rest)), SEGMENT)]
        for way, top in zip(*_ways(chunks, model), strict=True):
            now = now @ way
            log += top + math.log(now.sum())
            now = now / now.sum()
    return log


def score(
    docs: DataFrame, held_out: Column, text: str = "text", key: str = "doc_id", states: int = STATES, rounds: int = ROUNDS
) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row; logarithms to base 10."""
    texts = docs.select(F.col(key).cast("long").alias("key"), (~held_out).alias("train"), F.col(text).alias("text"))
    counts = settle(word_counts(texts.where("train")), "counts")
    known = vocabulary(counts, texts.where("train").count())
    table = settle(coded(texts, known), "coded")
    model = train(table, known, states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(plain(model))
    out = "uid long, key long, train boolean, n_tokens long, known long, head_log double, own_log double, path_log double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, model = arrow_type(out), Model(*shared.value)
        for batch in batches:
            sequences = [np.frombuffer(s.as_buffer(), np.uint16) for s in batch.column("symbols")]
            log = log_likelihoods(sequences, model) / math.log(10)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in schema if f.name != "path_log"], pa.array(log, pa.float64())], schema=schema
            )

    scored = table.drop("tail").mapInArrow(run, out).join(settle(rare_sums(table, counts), "rare"), "uid", "left")
    rare, below = F.coalesce("rare_log", F.lit(0.0)), math.log10(known.tokens + 0.5 * (known.distinct + 1))
    return scored.select(
        "key",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + rare - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (F.col("path_log") + F.col("own_log") + rare).alias("score"),
    )
