"""Toxicity by a weighted lexicon (operator 2).

Texts are folded first: lower case, accents stripped, letters of other scripts
and digits that look like a Latin letter replaced by one form, so that a spelling
in disguise meets its plain form. The lexicon is folded the same way.

The lexicon is learned from labelled rows. An entry is a whole word or the stem
that a word begins with; its weight is the log-odds of toxic against clean texts.
Evidence is counted in distinct surroundings (the words before and after), so that
many copies of one text count once, and has to exceed what chance gives among so
many candidates. Half as much is asked of the number of toxic texts and of the unrelated
surroundings, of which no two share the word before or the word after: edited copies
of one passage have hardly more than two of them, and a text that repeats a word is
one text. None of these counts falls as copies or repeats are added. Of entries that contain one another the one with the strongest
evidence stays. A phrase of two words that holds an entry but stands in clean texts
is an exception: where it matches, the entry inside does not count. Words and phrases are the patterns of one
Aho-Corasick automaton that reads each folded text once. The summed weight per
word of text goes into a logistic score fitted on the same rows.

Learning takes at most ``max_rows`` labelled rows of each class, the first by a
hash of their id; this is the only bound, and scoring reads every text whole.

Defined cases: null and empty texts have no match and get the score of a text
without one; rows repeated are scored each; rows without a label are scored alike;
without both classes to learn from the lexicon is empty and every score is the
clean one; an empty table gives no rows; extra columns pass through.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewire.llm.shared import arrow_batch, arrow_type, bounded_slices, plain, settle

#: Labelled rows of each class that are learned from at most.
MAX_ROWS = 20_000
#: Words and exception phrases of a lexicon at most, the strongest first; bounds what is sent to every task.
MAX_TERMS = 20_000
#: Expected number of words that pass the test of evidence by chance.
CHANCE = 0.01
#: Share of the evidence that toxic texts and unrelated surroundings have to reach; copies of few texts have fewer.
MIN_VARIETY = 0.5
#: Unrelated surroundings that are counted of a word; no entry needs more.
MAX_UNRELATED = 32
#: Distinct clean surroundings that an exception phrase needs.
MIN_CLEAN = 8
#: Least weight of an entry: it is so many times (e to the weight) likelier in toxic texts.
MIN_WEIGHT = 2.0
#: Letters of a stem.
STEM = (3, 10)

# fixed values: letters that look alike, each with the Latin letter that it is folded to
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ь": "b",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l", "ø": "o", "ł": "l", "đ": "d",
}
# fixed values: digits and signs written for letters; l and i share one form, since 1 stands for both
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "l": "i", "ł": "i", "ӏ": "i", "ℓ": "i"}
_SIGNS = str.maketrans({"@": "a", "$": "s", "!": "i", "|": "i", "€": "e"})
_SIGN_BEFORE_LETTER = re.compile(r"[@$!|€](?=[^\W\d_])")
_HIDDEN = "­​‌‍⁠﻿"


def _folding() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(a): b for a, b in _LOOKALIKES.items()}
    for block in (range(0x00C0, 0x0250), range(0x0300, 0x0370), range(0x0390, 0x0460), range(0x1E00, 0x1F00), range(0xFF10, 0xFF5B)):
        for code in block:
            if code not in table:
                plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
                plain = "".join(_LOOKALIKES.get(c, c) for c in plain)
                if plain != chr(code):
                    table[code] = plain or None
    table |= {ord(c): None for c in _HIDDEN}
    table |= {ord(a): b for a, b in _DIGITS.items()}
    for code, value in list(table.items()):
        if value:
            table[code] = "".join(_DIGITS.get(c, c) for c in value)
    return table


SEEN = "word string, place int, toxic long, clean long, texts long"
NEAR = "word string, prior int, later int"
_FOLD = _folding()
_WORDS = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The text in its plain form; words stay words."""
    text = text.lower()
    if _SIGN_BEFORE_LETTER.search(text):
        text = _SIGN_BEFORE_LETTER.sub(lambda m: m[0].translate(_SIGNS), text)
    return text.translate(_FOLD)


@dataclass(frozen=True)
class Lexicon:
    """Folded entries with weights, folded exception phrases, and the logistic fit.

    An entry that ends with a space is a whole word, any other one a stem.
    """

    words: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    #: intercept and factor of the logistic score
    fit: tuple[float, float] = (-4.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        for word, weight in self.words.items():
            found.add_word(f" {word}", (len(word) + 1, weight))
        if len(found):
            found.make_automaton()
        return found


def matches(text: str, automaton) -> tuple[float, int, int]:
    """Summed weight and number of the entries outside of exception phrases, and the number of words."""
    words = _WORDS.findall(fold(text))
    if not words or not len(automaton):
        return 0.0, 0, len(words)
    hits, spans = [], []
    for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
        (hits if weight else spans).append((end - length + 1, end, weight))
    if spans:  # both lists come in order of their ends; spans of two words overlap by a word at most
        ends = [end for _, end, _ in spans]
        hits = [h for h in hits if not any(a <= h[0] for a, _, _ in spans[bisect_left(ends, h[1]) :][:2])]
    return sum(w for _, _, w in hits), len(hits), len(words)


def density(weight: float | np.ndarray, size: float | np.ndarray) -> float | np.ndarray:
    """Weight per hundred words, on a logarithmic scale."""
    return np.log1p(100.0 * weight / np.maximum(size, 1))


def learn(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, text: str = "text", key: str = "doc_id", label: str = "toxic"
) -> Lexicon:
    """A lexicon from ``labels(key, label)`` and the texts of ``docs``; labels other than 0 and 1 are left out."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key IS NOT NULL AND label IN (0, 1)")
    # a class of more than max_rows is sampled; its rows then stand for more than one each, so no size moves the prior
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    scale = tuple(max(1.0, sizes.get(value, 0) / max_rows) for value in (0, 1))
    order = F.xxhash64("key")
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(order, "key").limit(max_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 x max_rows pairs of numbers
    chosen = F.broadcast(settle(chosen.groupBy("key").agg(F.max("label").alias("label")), "chosen"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    # of equal texts one is learned from; hashes travel, texts stay where they are read
    distinct = texts.join(chosen, "key").groupBy("label", F.xxhash64("text").alias("h")).agg(F.min("key").alias("key"))
    distinct = F.broadcast(settle(distinct.select("key", "label"), "distinct"))
    rows = settle(texts.join(distinct, "key").select("label", "text"), "labelled")
    seen = rows.mapInArrow(_surroundings, SEEN).groupBy("word", "place").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "texts")])
    per_word = settle(
        seen.groupBy("word").agg(
            F.count_if(F.col("toxic") > 0).alias("toxic"), F.count_if(F.col("clean") > 0).alias("clean"), F.sum("texts").alias("texts")
        ),
        "words",
    )
    total = per_word.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not total["toxic"] or not total["clean"]:
        return Lexicon()
    entries = settle(
        per_word.select(F.explode(_entries("word")).alias("entry"), "toxic", "clean", "texts")
        .groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "texts")]),
        "entries",
    )
    share = total["toxic"] * scale[1] / (total["toxic"] * scale[1] + total["clean"] * scale[0])
    evidence = math.ceil(math.log(max(entries.count(), 1) / CHANCE) / -math.log(share))
    variety = math.ceil(MIN_VARIETY * evidence)
    toxic, clean, both = F.col("toxic"), F.col("clean"), F.col("toxic") * scale[1] + F.col("clean") * scale[0]
    odds = F.log((toxic + 0.5) / (total["toxic"] + 1)) - F.log((clean + 0.5) / (total["clean"] + 1))
    gained, lost = F.log(toxic * scale[1] / (both * share)), F.log(clean * scale[0] / (both * (1 - share)))
    strength = toxic * gained + F.when(clean > 0, clean * lost).otherwise(0)
    likely = settle(
        entries.where((toxic >= evidence) & (F.col("texts") >= variety))
        .select("entry", odds.alias("weight"), strength.alias("strength")).where(f"weight >= {MIN_WEIGHT}"),
        "likely",
    )
    need = min(variety, MAX_UNRELATED)
    strongest = (
        likely.join(_unrelated(rows, per_word, likely, need).where(F.col("unrelated") >= need), "entry")
        .orderBy(F.desc("strength"), F.desc(F.length("entry")), "entry")
    )
    words: dict[str, float] = {}
    beginnings: set[str] = set()
    for row in _bounded(strongest):
        entry = row["entry"]
        if entry not in beginnings and not any(entry[:n] in words for n in range(1, len(entry) + 1)):
            words[entry] = row["weight"]
            beginnings.update(entry[:n] for n in range(1, len(entry) + 1))
    if not words:
        return Lexicon()
    exceptions = _exceptions(rows, Lexicon(words), scale)
    plain = Lexicon(words, exceptions)
    measured = rows.mapInArrow(_measure(plain), "label int, weight double, size long").toPandas()  # 2 x max_rows at most
    return Lexicon(words, exceptions, _fit(measured, scale))


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a word stands in a place, which is a hash of the words around it, summed per slice."""
    schema = arrow_type(SEEN)
    for batch in batches:
        for part in bounded_slices(batch, "text"):
            found, texts = (Counter(), Counter()), Counter()
            for label, text in zip(part.column("label").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = _WORDS.findall(fold(text))
                places = list(zip(words, map(_place, ["", *words], [*words[1:], ""]), strict=False))
                found[label].update(places)
                if label:  # a text counts at one place of each of its words
                    texts.update(dict(places).items())
            clean, toxic = found
            yield arrow_batch([(*at, toxic[at], clean[at], texts[at]) for at in toxic.keys() | clean.keys()], schema)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the texts with hashes of the word before and the word after, once per slice."""
    schema = arrow_type(NEAR)
    for batch in batches:
        for part in bounded_slices(batch, "text"):
            found = set()
            for text in part.column("text").to_pylist():
                words = _WORDS.findall(fold(text))
                codes = [_place("", ""), *(_place(w, "") for w in words), _place("", "")]
                found.update(zip(words, codes, codes[2:], strict=False))
            yield arrow_batch(list(found), schema)


def _unrelated(rows: DataFrame, per_word: DataFrame, likely: DataFrame, need: int) -> DataFrame:
    """``(entry, unrelated)``: the most toxic surroundings of its words that share neither side, up to ``need`` per word.

    That is a largest matching of words before with words after. ``need`` pairs of each
    word on a side are enough to find ``need`` unrelated ones, and so are need x need
    pairs in all, so no word brings more to one place.
    """
    words = settle(
        per_word.where("toxic > 0").select("word", F.explode(_entries("word")).alias("entry")).join(likely.select("entry"), "entry"),
        "likely_words",
    )
    pairs = rows.where("label = 1").select("text").mapInArrow(_neighbours, NEAR)
    pairs = pairs.join(words.select("word").distinct(), "word", "left_semi").distinct()
    for side, other, most in (("prior", "later", need), ("later", "prior", need), (None, "prior", need * need)):
        within = Window.partitionBy("word", *([side] if side else [])).orderBy(other, *([] if side else ["later"]))
        pairs = pairs.withColumn("_nth", F.row_number().over(within)).where(F.col("_nth") <= most).drop("_nth")

    @F.pandas_udf("long")
    def matched(priors: pd.Series, laters: pd.Series) -> pd.Series:
        return pd.Series([matching(p, q, need) for p, q in zip(priors, laters, strict=True)], dtype="int64")

    near = pairs.groupBy("word").agg(F.collect_list(F.struct("prior", "later")).alias("near"))
    counted = near.select("word", matched("near.prior", "near.later").alias("n"))
    return words.join(counted, "word").groupBy("entry").agg(F.sum("n").alias("unrelated"))


def matching(left, right, most: int) -> int:
    """The most of the pairs ``(left[i], right[i])`` that share neither side, up to ``most``."""
    beside: dict[int, list[int]] = {}
    for a, b in zip(left, right, strict=True):
        beside.setdefault(a, []).append(b)
    taken: dict[int, int] = {}

    def place(a: int, seen: set[int]) -> bool:
        for b in beside[a]:
            if b not in seen:
                seen.add(b)
                if b not in taken or place(taken[b], seen):
                    taken[b] = a
                    return True
        return False

    for a in beside:
        if len(taken) >= most:
            break
        place(a, set())
    return len(taken)


def _place(prior: str, later: str) -> int:
    return zlib.crc32(f"{prior} {later}".encode()) - (1 << 31)


def _entries(word: str) -> Column:
    """The stems of a word, and the whole of it."""
    length = F.length(word)
    low, high = STEM
    stems = F.transform(F.sequence(F.lit(low), F.least(length, F.lit(high))), lambda n: F.substring(F.col(word), F.lit(1), n))
    whole = F.array(F.concat(F.col(word), F.lit(" ")))
    return F.when(length >= low, F.concat(whole, stems)).otherwise(whole)


def _bounded(found: DataFrame) -> list:
    """The rows of ``found``; more than MAX_TERMS are an error, none is left out."""
    rows = found.limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} entries; learn from fewer rows than MAX_ROWS")
    return rows


def _exceptions(rows: DataFrame, lexicon: Lexicon, scale: tuple[float, float]) -> frozenset[str]:
    """Phrases of two words with an entry that clean texts hold and toxic ones hardly do."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, automaton = arrow_type("label int, phrase string, side string"), lexicon.automaton()
        for batch in batches:
            for part in bounded_slices(batch, "text"):
                found = set()
                for label, text in zip(part.column("label").to_pylist(), part.column("text").to_pylist(), strict=True):
                    plain = f" {' '.join(_WORDS.findall(fold(text)))} "
                    for end, (length, _) in automaton.iter(plain):
                        start = end - length + 2
                        stop = plain.index(" ", start)
                        prior = plain[plain.rfind(" ", 0, start - 1) + 1 : start - 1]
                        later = plain[stop + 1 : max(plain.find(" ", stop + 1), stop + 1)]
                        if prior:
                            found.add((label, f"{prior} {plain[start:stop]}", later))
                        if later:
                            found.add((label, f"{plain[start:stop]} {later}", prior))
                yield arrow_batch(list(found), schema)

    pairs = rows.mapInArrow(near, "label int, phrase string, side string").distinct()
    clean, toxic = F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)
    found = pairs.groupBy("phrase").agg(clean.alias("clean"), toxic.alias("toxic"))
    found = found.where((F.col("clean") >= MIN_CLEAN) & (F.col("clean") * scale[0] >= 4 * scale[1] * F.col("toxic")))
    return frozenset(r["phrase"] for r in _bounded(found))


def _measure(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, automaton = arrow_type("label int, weight double, size long"), lexicon.automaton()
        for batch in batches:
            rows = []
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                weight, _, size = matches(text, automaton)
                rows.append((label, weight, size))
            yield arrow_batch(rows, schema)

    return run


def _fit(rows: pd.DataFrame, scale: tuple[float, float]) -> tuple[float, float]:
    """Logistic regression by Newton steps, with a small penalty that keeps separable classes finite.

    ``scale`` is how many labelled rows a row of each class stands for.
    """
    y = rows["label"].to_numpy(float)
    x = np.column_stack([np.ones(len(y)), density(rows["weight"].to_numpy(), rows["size"].to_numpy())])
    w = np.where(y > 0, scale[1], scale[0])
    b, penalty = np.zeros(2), np.diag([1e-3, 1e-2]) * max(w.sum() / 100, 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (w * (y - p)) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def rating(spark: SparkSession, lexicon: Lexicon, text: Column) -> Column:
    """``struct<score: double, n_matches: long>`` of a text column; the score is 0 to 1."""
    shared = spark.sparkContext.broadcast(plain(lexicon))  # MAX_TERMS bounds it

    @F.pandas_udf("score double, n_matches long")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(*shared.value)
        automaton = lexicon.automaton()
        base, factor = lexicon.fit
        for texts in parts:
            rows = []
            for t in texts:
                weight, n, size = matches(t or "", automaton)
                rows.append((1 / (1 + math.exp(-max(-30.0, min(30.0, base + factor * density(weight, size))))), n))
            yield pd.DataFrame(rows, columns=["score", "n_matches"])

    return rate(text)
