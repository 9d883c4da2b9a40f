"""Texts of more than one segment against every window."""

from collections import Counter

import numpy as np

from plumeline.llm import dedup_substrings as D


def test_repeats_across_a_segment_boundary(spark):
    rng = np.random.default_rng(8)
    random = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    near, far = random(400), random(230)
    texts = [random((1 << 20) - 100) + near + random(5000) + far, random(50) + near + random(70),
             random(700) + far + random(10), random(300)]
    windows = Counter(t[i:i + D.LENGTH] for t in texts for i in range(len(t) - D.LENGTH + 1))
    wanted = {}
    for k, t in enumerate(texts):
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - D.LENGTH + 1):
            if windows[t[i:i + D.LENGTH]] > 1:
                gone[i:i + D.LENGTH] = 1
        wanted[k] = (int(gone.sum()), int((np.diff(np.r_[0, gone]) == 1).sum()))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in D.remove_repeats(df, {"doc_id": df.doc_id}).collect()}
    assert got == wanted and wanted[0] == (630, 2) and wanted[1] == (400, 1)


def test_anchors_lie_in_their_windows():
    data = np.random.default_rng(9).integers(97, 123, (1 << 20) + 3000).astype(np.uint8).tobytes()
    for pos, lo, hi, _, _ in D._text_anchors(data, D.LENGTH, D.ANCHOR):
        assert (lo <= 0).all() and (hi <= 0).all() and (lo >= D.ANCHOR - D.LENGTH).all() and (pos + lo >= 0).all()
