import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from plumeline.llm import periodic
from plumeline.llm.queries import QUERIES


def brute(words):
    """Every maximal run by its definition: per period, stretches of words equal to the one q on."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, n):
    rng = np.random.default_rng(seed)
    out = ["", " \t\n", "a", "a " * 5, "a " * 6, "x " + "a b c " * 4, "a b c d " * 40 + "a b", "a a a a a a b " * 9]
    while len(out) < n:
        parts = []
        for _ in range(int(rng.integers(1, 6))):
            unit = [f"w{k}" for k in rng.integers(0, int(rng.integers(1, 9)), int(rng.integers(1, 12)))]
            parts += unit * int(rng.integers(1, 9)) + unit[:int(rng.integers(0, len(unit) + 1))]
        out.append("  ".join(parts))
    return out


@pytest.mark.parametrize("block", [1, 50, 1 << 18])
def test_against_every_period(spark, block):
    rows = list(enumerate(texts(block, 250)))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = {r.row: r for r in periodic.find_runs(df, {"row": df.doc_id}, block_words=block).collect()}
    for i, t in rows:
        words = t.split()
        wanted = brute(words)
        assert [tuple(r) for r in got[i].runs] == wanted, t
        assert (got[i].n_words, got[i].collapsed) == (len(words), collapsed(words, wanted))


def test_edge_rows(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "é é " * 7, 1), (1, "é é " * 7, 1), (2, "b " * 300_000, 2)],
                               "doc_id long, text string, text_ int")
    got = periodic.find_runs(df, {"doc_id": df.doc_id, "_id": df.text_}).collect()
    assert sorted((r.doc_id or 0, r._id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == [
        (0, 1, 0, [], ""), (1, 1, 7, [(0, 7, 1)], "é é"), (1, 1, 7, [(0, 7, 1)], "é é"),
        (2, 2, 300_000, [(0, 300_000, 1)], "b")]
    assert periodic.find_runs(df.limit(0), {"doc_id": df.doc_id}).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(df, {"runs": df.doc_id})
    with pytest.raises(ValueError):
        periodic.find_runs(df, {"doc_id": df.doc_id}, repeats=3)


def test_query_against_plain_python(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    assert set(got) == set(docs)
    planted = 0
    for d, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(d).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        runs = brute(words)
        digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        assert tuple(got[d]) == (
            d, len(runs), *best, runs and 1000 * best[1] // best[2] or None, digest,
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    assert planted > 5
