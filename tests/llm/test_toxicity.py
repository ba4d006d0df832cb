import random

import pytest
from pyspark.sql import functions as F

from tablewire.llm import toxicity


@pytest.mark.parametrize("plain,disguised", [
    ("trash", "Tr4sh"), ("stupid", "ѕtuріd"), ("loser", "1ОSER"), ("idiot", "іdï0t"), ("scum", "$cum"), ("scum", "ｓｃｕｍ"), ("moron", "m​or­on"),
    ("hat", "h@t"), ("illness", "i11ness"),
])
def test_folding_meets_disguises(plain, disguised):
    assert toxicity.fold(disguised) == toxicity.fold(plain)


def brute(text, lexicon):
    """Matches by looking at every word and phrase."""
    words = toxicity._WORDS.findall(toxicity.fold(text))
    weight = n = 0
    for i, word in enumerate(words):
        near = {" ".join(words[max(i - 1, 0) : i + 1]), " ".join(words[i : i + 2])}
        if near & lexicon.exceptions:
            continue
        for entry, value in lexicon.words.items():
            if word == entry.strip() if entry.endswith(" ") else word.startswith(entry):
                weight, n = weight + value, n + 1
    return weight, n, len(words)


@pytest.mark.parametrize("seed", range(40))
def test_matches_are_those_of_every_word(seed):
    rng = random.Random(seed)
    lexicon = toxicity.Lexicon({"bad ": 2.0, "vi": 1.5, "ugiy ": 1.0}, frozenset({"bad ioan", "not bad", "vie a"}))
    vocabulary = ["bad", "loan", "not", "vile", "vie", "a", "ugly", "uglyness", "abad", "word,", "BAD!", "b4d"]
    text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))
    found, want = toxicity.matches(text, lexicon.automaton()), brute(text, lexicon)
    assert found[1:] == want[1:] and abs(found[0] - want[0]) < 1e-9


def test_empty_lexicon():
    assert toxicity.matches("some text", toxicity.Lexicon().automaton()) == (0.0, 0, 2)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    calm = [f"word{i}" for i in range(400)] + ["fire"] * 20
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(calm) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["scoundrel", "villain", f"wretch{rng.choice(['ed', 'es', 'y'])}"])
        elif i % 9 == 0:
            words[5:7] = ["villain", "song"]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learning(spark, docs_of, corpus):
    rows, labels = corpus
    table = spark.createDataFrame([*labels, (None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs_of(rows), table)
    assert "scoundrei" in {w.strip() for w in lexicon.words} or any("scoundrei".startswith(w) for w in lexicon.words)
    assert any("wretched".startswith(w) for w in lexicon.words if not w.endswith(" "))
    assert lexicon.exceptions == {"viiiain song"}
    truth = dict(labels)
    docs = docs_of([*rows, (900, None, "s"), (901, "", "s"), (None, "scoundrel villain wretched", "s")])
    rated = docs.select("doc_id", toxicity.rating(spark, lexicon, F.col("text")).alias("r")).collect()
    assert len(rated) == len(rows) + 3
    wrong = [r.doc_id for r in rated if r.doc_id in truth and (r.r.score >= 0.5) != truth[r.doc_id]]
    assert len(wrong) < 0.03 * len(rows)
    by_id = {r.doc_id: r.r for r in rated}
    assert by_id[900].score < 0.5 and by_id[901].score < 0.5 and by_id[None].score > 0.5


def test_nothing_to_learn(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs_of([(1, "a b", "s")]), none)
    assert lexicon == toxicity.Lexicon()
    assert toxicity.learn(docs_of([]), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")) == toxicity.Lexicon()
    rated = docs_of([(1, "a b", "s")]).select(toxicity.rating(spark, lexicon, F.col("text")).alias("r")).first().r
    assert rated.score < 0.5 and rated.n_matches == 0


def likely_words(lexicon, *words):
    return [any(f"{toxicity.fold(w)} ".startswith(e) for e in lexicon.words) for w in words]


def test_copies_and_repeats_take_no_entry_out(spark, docs_of, corpus):
    rows, labels = corpus
    plain = toxicity.learn(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert likely_words(plain, "scoundrel", "villain") == [True, True]
    rng = random.Random(3)
    passage = "what a scoundrel he was said the harbour keeper of that villain near the lighthouse steps".split()
    more, marks = [], []
    for i in range(2000):  # one edited word in each copy
        words = passage[:]
        words[rng.randrange(len(words))] = f"edit{i}"
        more.append((5000 + i, " ".join(words), "s"))
        marks.append((5000 + i, 1))
    more.append((9000, "you are a scoundrel and a villain too " * 300, "s"))
    marks.append((9000, 1))
    lexicon = toxicity.learn(docs_of([*rows, *more]), spark.createDataFrame([*labels, *marks], "doc_id long, toxic int"))
    assert likely_words(lexicon, "scoundrel", "villain") == [True, True]
    assert likely_words(lexicon, "harbour", "lighthouse", "keeper") == [False, False, False]


@pytest.mark.parametrize("seed", range(20))
def test_matching(seed):
    from itertools import combinations

    rng = random.Random(seed)
    pairs = list({(rng.randrange(5), rng.randrange(5)) for _ in range(rng.randint(1, 9))})
    best = max(
        n for n in range(1, len(pairs) + 1)
        if any(len({a for a, _ in c}) == len({b for _, b in c}) == n for c in combinations(pairs, n))
    )
    for most in (1, 2, 9):
        assert min(toxicity.matching(*zip(*pairs), most), most) == min(best, most)
