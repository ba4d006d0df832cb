import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tablewire.llm import fim


def expected(key, text, rate, spm_rate, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return key, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    yield from ["", "\n", "\n\n", "a", "a\n", "a\nb", "\na", "a\r\nb\x0bc d\n", "x<P>y\nz", "<S>", "an <M> in it", "<P", "P>\n<S\nM>"]
    yield from ["Zeile ü 😀\n" * n + "end" for n in range(1, 30)]
    yield "one line\n" * 40_000 + "x" * 3_000_000


@pytest.mark.parametrize(("rate", "spm_rate"), [(100, 50), (60, 0), (60, 100), (0, 50)])
def test_against_brute_force(docs_of, odd_rows, rate, spm_rate):
    rows = [*odd_rows, *((100 + k, t, "s") for k, t in enumerate(texts()))]
    found = fim.fill_in_middle(docs_of(rows), rate=rate, spm_rate=spm_rate).withColumn("back", fim.restored())
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == sorted(((*expected(i, t, rate, spm_rate), t or "") for i, t, _ in rows), key=repr)


def test_forms_and_empty_table(docs_of, spark):
    found = fim.fill_in_middle(docs_of([(k, "a\nb\nc\n", "s") for k in range(400)]))
    n = {r["form"]: r["n"] for r in found.groupBy("form").agg(F.count("*").alias("n")).collect()}
    assert set(n) == {"psm", "spm"} and min(n.values()) > 150
    assert fim.fill_in_middle(docs_of([(1, "a", "s")]).limit(0)).count() == 0
