import hashlib
from collections import Counter

import numpy as np
import pytest

from plumeline.llm import dedup_substrings as S
from plumeline.llm.suffix import Hashed, sort_suffixes


def brute(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i + 1:i + 1 + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 9))) for _ in range(400)]
    make = lambda n: " ".join(rng.choice(words, n))
    passage, texts = make(90), []
    for i in range(40):
        t = make(int(rng.integers(5, 200)))
        if i % 3 == 0:
            t += passage + make(20)
        if i % 5 == 0 and texts:
            old = texts[int(rng.integers(len(texts)))].split(" ")
            old[int(rng.integers(len(old)))] = "EDIT"
            t = " ".join(old)
        texts.append(t)
    return texts + [texts[3], texts[3], "", "x" * 450, "ab" * 300, "short", passage[:250], make(30) + passage[:203]]


def test_suffix_sort():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 900).astype(np.uint8)
    starts = rng.permutation(800)
    segments = np.sort(rng.integers(0, 7, 800))
    order = sort_suffixes(Hashed(data), starts, segments, 40)
    wanted = sorted(range(800), key=lambda i: (segments[i], data[starts[i]:starts[i] + 40].tobytes()))
    assert [data[starts[i]:starts[i] + 40].tobytes() for i in order] == [
        data[starts[i]:starts[i] + 40].tobytes() for i in wanted]


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 2)])
def test_against_all_windows(spark, seed, block):
    texts = corpus(seed)
    rows = [(i if i != 7 else None, t, i) for i, t in enumerate(texts)] + [(99, None, 99)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pos long")
    got = S.remove_repeats(df, {"row": df.pos}, block=block).collect()
    wanted = brute([(t or "").encode() for _, t, _ in rows], 200)
    assert {r.row: tuple(r)[1:] for r in got} == dict(enumerate(wanted[:-1])) | {99: wanted[-1]}


def test_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "z y " * 100)] * 2 + [(2, "q")], "doc_id long, text string")
    got = sorted(map(tuple, S.remove_repeats(df, {"doc_id": df.doc_id}).collect()))
    assert [g[:4] for g in got] == [(1, 400, 400, 1), (1, 400, 400, 1), (2, 1, 0, 0)]
    assert S.remove_repeats(df.limit(0), {"doc_id": df.doc_id}).count() == 0


def test_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(S, "_SEGMENT", 300)
    found = [a for part in S._text_anchors(b"".join(b"%d," % i for i in range(1000)), 200, 64) for a in zip(*part)]
    covered = sorted(p + o for p, lo, hi, _, _ in found for o in range(lo, hi + 1))
    assert covered == list(range(len(b"".join(b"%d," % i for i in range(1000))) - 199))
