import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from plumeline.llm import collocations as C


def brute(rows, least, top, inside=80):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    out = []
    for lang in sorted({r[0] or "und" for r in rows}):
        f, n = Counter(), 0
        for _, text in (r for r in rows if (r[0] or "und") == lang):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        found = {g: a for g, a in f.items() if a >= least and len(g) > 1}
        scored = []
        for g, a in found.items():
            if any(100 * b >= inside * a and len(h) > len(g) and any(
                    h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in found.items()):
                continue
            cuts = [(2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, g, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n, -score))
    return out


def texts(seed, n):
    rng, out = np.random.default_rng(seed), []
    words = ["Aa", "b", "É", "d'e", "ff", "g", "\xa0h", "zz"]
    for _ in range(n):
        parts = [str(rng.choice(words)) + str(rng.choice([" ", " ", "\t ", ", ", ".", "\n", " ! "]))
                 for _ in range(int(rng.integers(0, 40)))]
        out.append((["en", "de", None, "und"][int(rng.integers(0, 4))], "".join(parts)))
    return out


@pytest.mark.parametrize("seed,least,shard", [(1, 5, 1 << 20), (2, 3, 60), (3, 2, 500), (4, 40, 100)])
def test_against_counting_every_phrase(spark, seed, least, shard):
    rows = texts(seed, 300)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = C.collocations(df, min_count=least, top=50, shard_words=shard)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, 50)


def test_edge_rows(spark):
    rows = [(None, None, 1), ("en", "", 1), ("en", " .,\n", 1)] + [("en", "x y " * 400, 1)] * 2
    df = spark.createDataFrame(rows, "lang string, text string, phrase int")
    got = sorted(map(tuple, C.collocations(df, top=10).collect()))
    assert got == brute([r[:2] for r in rows], 30, 10) and got
    assert C.collocations(df.limit(0)).count() == 0
    assert C.collocations(df.limit(3)).count() == 0


def test_suffix_order_and_intervals():
    rng = np.random.default_rng(6)
    ids = np.r_[0, rng.integers(0, 4, 500), 0].astype(np.int32)
    for big in (1, 1 << 20):  # large numbers take the way over names
        text = ids.astype(np.int64) * big
        order = C.suffix_order(text, 4)
        padded = [*text.tolist(), 0, 0, 0, 0]
        keys = [padded[i:i + 4] for i in order]
        assert keys == sorted(keys)
    index = C.Index(C.reduced(ids, np.arange(3)), 3)
    first, second, low, count = index.pairs()
    seen = Counter(zip(ids.tolist(), ids[1:].tolist()))
    assert {(a, b): n for a, b, n in zip(first, second, count)} == {k: n for k, n in seen.items() if all(k)}
    parent, word, n, _ = index.forward.grow(low, count)
    triples = Counter(zip(ids.tolist(), ids[1:].tolist(), ids[2:].tolist()))
    assert {(w, first[p], second[p]): c for p, w, c in zip(parent, word, n)} == {
        k: n for k, n in triples.items() if all(k)}


@pytest.mark.parametrize("seed,least,shard,block", [(5, 3, 60, 40), (6, 2, 200, 1 << 21)])
def test_sums_over_few_and_many_blocks(spark, monkeypatch, seed, least, shard, block):
    monkeypatch.setattr(C, "BLOCK_WORDS", block)
    rows = texts(seed, 200)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    got = C.collocations(df, min_count=least, top=50, shard_words=shard)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, 50)


def test_blocks_add_up_and_answer():
    rng, blocks, counts, sent, told = np.random.default_rng(7), 7, Counter(), [], {}
    for shard in range(5):
        pairs = sorted({tuple(p) for p in rng.integers(0, 1 << 40, (30, 2)) << rng.integers(0, 20)} |
                       {(1 << 50, i) for i in range(20)} | {(i, 3) for i in range(shard)})
        keys, n = [np.array(k) for k in zip(*pairs)], rng.integers(1, 9, len(pairs))
        counts.update(dict(zip(pairs, n.tolist())))
        sent.append(C._dealt(shard, keys, n, blocks))
        told[shard] = pairs, keys
    table = pa.Table.from_batches(sent)
    out = pa.concat_tables([C._frequent_pairs(12)(table.filter(pc.equal(table["block"], b)))
                            for b in pc.unique(table["block"]).to_pylist()])
    found = out.filter(pc.is_null(out["shard"])).to_pylist()
    names = {(r["a"], r["b"]): r["name"] for r in found}
    assert {(r["a"], r["b"]): r["total"] for r in found} == {p: n for p, n in counts.items() if n >= 12}
    assert len(set(names.values())) == len(found) > 0
    for shard, (pairs, keys) in told.items():
        place, name = C._told(keys, out.filter(pc.equal(out["shard"], shard)), blocks)
        assert list(zip(place, name)) == [(i, names[p]) for i, p in enumerate(pairs) if p in names]


_SHUFFLED = """
import json, sys
from pathlib import Path
import numpy as np
from pyspark.sql import SparkSession
sys.path.insert(0, sys.argv[1])
from plumeline.llm import collocations as C
there = Path(sys.argv[2])
(there / "events").mkdir()
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", str(there / "scratch"))
         .config("spark.local.dir", str(there / "local")).config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", str(there / "events")).config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").getOrCreate())
rng = np.random.default_rng(8)
rows = [(" ".join(f"w{i}" for i in rng.zipf(1.3, 2000) % 4000),) for _ in range(300)]
df = spark.createDataFrame(rows, "text string").selectExpr("'en' as lang", "text").repartition(4)
C.phrases(df, shard_words=1 << 15)
spark.stop()
sent = 0
for file in (there / "events").iterdir():
    for line in file.open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            sent += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
print("shuffled", sent / sum(len(r[0]) for r in rows))
"""


def test_rare_pairs_travel_packed(tmp_path):
    """Bytes of all shuffles against those of the texts, where most pairs are too rare."""
    run = subprocess.run([sys.executable, "-c", _SHUFFLED, str(Path(__file__).resolve().parents[2]), str(tmp_path)],
                         capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert float(run.stdout.split("shuffled")[1]) < 2.7  # 3.4 with one row for each pair of a shard, 2.1 packed
