import numpy as np
import xxhash

from plumeline.llm import simhash


def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (1 << 64) - 1).count("1") <= simhash.RADIUS:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(root(i), []).append(ids[i])
    return {ids[i]: min(groups[root(i)]) for i in range(len(fps))}


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + size]), 42)
              for i in range(len(words) - size + 1)]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint():
    for text in ("", " \n\t", "One", "a b c", "É É a A b", "x y z", "w " * 40, "a b c d e f g"):
        assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == 0


def planted(seed, n=300):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        base = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 6))):
            flips = sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 7)), replace=False))
            out.append(base ^ flips)
    return [v - (1 << 64) if v >> 63 else v for v in dict.fromkeys(out)]


def test_runs_give_a_spanning_forest():
    fps = planted(1, 120)
    forest = simhash.near_links(np.array(fps, np.int64), np.zeros(len(fps), np.int64))
    expected = brute_components(fps, fps)
    assert len(forest) == len(fps) - len(set(expected.values()))
    for u, v in forest:
        assert bin((u ^ v) & (1 << 64) - 1).count("1") <= 4 and expected[u] == expected[v]


def test_components_against_all_pairs(spark):
    fps = planted(2)
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    expected = brute_components(fps, fps)
    from plumeline.llm.components import components
    for hot in (simhash.HOT_BUCKET, 2):  # 2: nearly every bucket is cut again
        roots = dict(map(tuple, components(simhash.links(frame, hot=hot)).collect()))
        assert {f: roots.get(f, f) for f in fps} == expected


def test_edge_rows(spark):
    schema = "doc_id long, text string, fp string, _key int"
    rows = [(1, None, "a", 1), (2, "", "b", 1), (2, "", "b", 1), (5, "one two three four five", "x", 2),
            (4, "one two three four five", "x", 2), (None, "other words stand here now", "y", None)]
    df = spark.createDataFrame(rows, schema)
    found = simhash.near_duplicates(df, {"doc_id": df.doc_id})
    got = sorted((tuple(r) for r in found.select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (2, 1), (5, 4), (4, 4), (None, None)], key=str)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "None"]
    twice = spark.createDataFrame([(7, "same words here again", "b", 1)] * 3, schema)
    assert simhash.keep_one(twice).count() == 1
    empty = df.limit(0)
    assert simhash.near_duplicates(empty, {"doc_id": empty.doc_id}).count() == 0
    assert simhash.keep_one(empty).count() == 0
