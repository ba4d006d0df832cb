import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablewire.llm import lines


def normal(line):
    return re.sub(r"[\t-\r ]+", " ", line).strip(" ")


def expected(rows, min_sites, max_share, min_words):
    sites, first = defaultdict(set), {}
    for key, text, site in rows:
        for place, raw in enumerate((text or "").split("\n") if text is not None else []):
            body = normal(raw)
            if len(body.split(" ")) >= min_words:
                if site is not None:
                    sites[body].add(site)
                if key is not None:
                    first[body] = min(first.get(body, (key, place)), (key, place))
    shared = {b for b, s in sites.items() if len(s) >= min_sites}
    out = []
    for key, text, _ in rows:
        if text is None or key is None:
            out.append((key, text))
            continue
        parts = text.split("\n")
        words = [len(normal(p).split(" ")) if normal(p) else 0 for p in parts]
        held = [normal(p) in shared for p in parts]
        copied = any(t == text and k is not None and k != key for k, t, _ in rows)
        if copied and sum(w for w, h in zip(words, held) if h) > max_share * sum(words):
            out.append((key, text))
        else:
            out.append((key, "\n".join(p for i, p in enumerate(parts) if not held[i] or first[normal(p)] == (key, i))))
    return sorted(out, key=repr)


def rows_of(n):
    rows = []
    for i in range(n):
        text = f"own words of document {i} here and more\nshared by all sites of all\n  shared by   all sites of all \nfew words {i}"
        if i % 3 == 0:
            text += f"\nshared by the thirds of them"
        if i % 10 == 0:
            text = "shared by all sites of all" + ("" if i % 20 else "\nshared by the thirds of them\nand something of its own here" + " " * i)
        rows.append((i, text, f"site{i % 12}"))
    return rows + [(n, "tiny line\nshared by all sites of all\nand something of its own here", None)]


@pytest.mark.parametrize("min_sites", [2, 4, 5, 12, 13])
def test_whole_texts(docs_of, odd_rows, min_sites):
    rows = rows_of(60) + [(k and k + 500, t, s) for k, t, s in odd_rows]
    docs = docs_of(rows, 3)
    out = lines.remove_boilerplate(docs, min_sites=min_sites, max_share=0.9, min_words=4)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == expected(rows, min_sites, 0.9, 4)


def test_estimates_above_and_exact_counts_near(docs_of):
    rows = [(1000 * s + i, f"line for many sites\nsome for site group {s % 40} only", f"s{s}") for s in range(300) for i in range(2)]
    table = lines.line_table(docs_of(rows), "text", "doc_id", "source", 4)
    found = {r.line: r for r in lines.boilerplate_lines(table, 7).collect()}
    hashes = {t: r.h for t in ("line for many sites", "some for site group 1 only", "some for site group 30 only") for r in docs_of([(1, t, "a")]).select(F.xxhash64("text").alias("h")).collect()}
    many = found[hashes["line for many sites"]]
    assert not many.exact and abs(many.n_sites - 300) < 60
    assert found[hashes["some for site group 1 only"]].exact and found[hashes["some for site group 1 only"]].n_sites == 8
    assert found[hashes["some for site group 30 only"]].n_sites == 7
    assert len(found) == 41


def test_empty_table_and_null_sites(docs_of):
    assert lines.remove_boilerplate(docs_of([])).collect() == []
    rows = [(i, "a line that nobody owns", None) for i in range(20)]
    assert all(r.text == rows[0][1] for r in lines.remove_boilerplate(docs_of(rows), min_sites=2).collect())


def test_names_of_its_own_in_extra_columns(docs_of):
    rows = rows_of(40)
    names = ["_key", "_version", "_shared", "_again", "_whole", "_held_key", "__again", "candidate", "line"]
    docs = docs_of(rows).withColumns({c: F.lit(c) for c in names})
    out = lines.remove_boilerplate(docs, min_sites=4)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == expected(rows, 4, 0.9, 4)
    assert out.select(*names).distinct().collect() == [tuple(names)]
    whole = lines.remove_boilerplate(docs, min_sites=4, copies=lambda found: found.select("candidate"))
    assert whole.columns == docs.columns and whole.count() == 41
