import hashlib

import numpy as np
import pytest

from plumeline.llm import passages


def brute(rows, window):
    """(id, text) rows: words left after removing every window that starts in a smaller id too."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        spans = [k for k in sorted(gone) if k - 1 not in gone], [k for k in sorted(gone) if k + 1 not in gone]
        out.append((len(w), len(gone), list(zip(*spans)), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def removed(spark, rows, **options):
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, row long")
    got = passages.remove_passages(df, {"row": df.row}, with_text=True, **options).collect()
    assert len(got) == len(rows)
    return [(r.n_words, r.n_removed, [tuple(x) for x in r.repeats], r.kept_sha256, r.kept_text)
            for r in sorted(got, key=lambda r: r.row)]


@pytest.mark.parametrize("seed,letters,window,gram", [(1, 2, 6, 2), (2, 3, 9, 2), (3, 2, 12, 1), (4, 5, 7, 7)])
def test_against_all_windows(spark, seed, letters, window, gram):
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{k}" for k in rng.integers(0, letters, n)]
    passage, rows = word(30), []
    for i in range(70):
        t = word(int(rng.integers(0, 25)))
        if i % 3 == 0:
            a, b = sorted(rng.integers(0, 31, 2))
            t = t[:5] + passage[a:b] + t[5:]
        if i % 5 == 4:
            t = rows[int(rng.integers(len(rows)))][1].split()
            if t:
                t[int(rng.integers(len(t)))] = "edit"
        rows.append((int(rng.integers(0, 60)) if i % 11 else None, " ".join(t)))
    assert removed(spark, rows, window=window, gram=gram) == brute(rows, window)


def test_long_passages_and_edges(spark):
    rng = np.random.default_rng(9)
    word = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 3000, n))
    hot = word(80)
    rows = [(200 - i, f"{word(30)} {hot}  {word(20)}") for i in range(60)]
    rows += [(7, word(49)), (3, None), (None, hot), (4, ""), (4, "a " * 70), (6, "a\n" * 70), (5, "é " * 50)]
    rows += [rows[0], rows[0], (300, rows[1][1]), (301, word(4000) + " " + hot[9:])]
    assert removed(spark, rows) == brute(rows, 50)


def test_empty_and_names(spark):
    df = spark.createDataFrame([(1, "a b", 2)], "doc_id long, text string, kind int")
    assert passages.remove_passages(df.limit(0), {"doc_id": df.doc_id}).count() == 0
    got = passages.remove_passages(df, {"kind": df.kind, "first": df.doc_id, "seed": df.kind}).collect()
    assert [(r.kind, r.first, r.seed, r.n_words) for r in got] == [(2, 1, 2, 2)]
    with pytest.raises(ValueError):
        passages.remove_passages(df, {"n_words": df.kind})
