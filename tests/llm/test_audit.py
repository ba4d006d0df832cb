import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from tablewire.llm import audit


def failing(rows):
    """Letters that every row fails, in plain Python."""
    out = []
    for key, text, _ in rows:
        text = text or ""
        words, letters = re.findall(r"[^\x20\x09-\x0D]+", text), ""
        letters += "A" if len(words) < 50 else ""
        letters += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        letters += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        letters += "D" if re.search("[#$%&*|]", text) else ""
        smaller = [k for k, t, _ in rows if k is not None and key is not None and k < key and (t or "") == text]
        out.append(letters + ("E" if smaller else ""))
    return out


def brute_force(rows, labels, names="ABCDE"):
    fails, good, toxic = failing(rows), {k for k, q, _ in labels if q == 1}, {k for k, _, t in labels if t == 1}
    found = set()
    for part in {s or "" for _, _, s in rows}:
        mine = [(k, f) for (k, _, s), f in zip(rows, fails, strict=True) if (s or "") == part]
        shapley, steps = dict.fromkeys(names, 0), []
        for order in permutations(names):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(k, f) for k, f in left if letter in f]
                left = [(k, f) for k, f in left if letter not in f]
                shapley[letter] += len(gone)
                steps.append((
                    "".join(order), step, len(left), len(gone), sum(letter in f for _, f in mine) - len(gone),
                    sum(f == letter for _, f in mine), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone),
                ))
        found |= {(part, *s, shapley[s[0][s[1] - 1]]) for s in steps}
    return found


def test_against_brute_force(spark, docs_of, odd_rows):
    rng = random.Random(5)
    pool = ["word", "Word", "ÄB", "x#y", "CAPS", "und", "a|b"] + [f"w{k}" for k in range(80)]
    rows = list(odd_rows)
    for key in range(20, 160):
        text = " ".join(rng.choices(pool[rng.choice([0, 7]) :], k=rng.choice([3, 49, 50, 51, 90])))
        rows.append((key, text, rng.choice(["a", "b", "", None])))
    rows += [(key + 500, rows[20 + key % 10][1], "a") for key in range(60)] + [rows[30]] * 5
    labels = [(rng.choice([None, *range(170)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.audit(docs_of(rows), table, audit.word_filters(), copies="E")
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) == 600 * len({s or "" for _, _, s in rows})
    assert set(got) == {r for r in brute_force(rows, labels)}


def test_no_failure_and_no_rows(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    filters = {"A": F.length("text") < 3, "B": F.col("text").contains("zz")}
    clean = audit.audit(docs_of([(1, "abcd", "s"), (2, "abcde", None)]), labels, filters)
    rows = clean.collect()
    assert len(rows) == 2 * 4
    assert {(r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in rows} == {(1, 0, 0, 0, 0)}
    assert audit.audit(docs_of([(1, "abcd", "s")]).limit(0), labels, filters).count() == 0
