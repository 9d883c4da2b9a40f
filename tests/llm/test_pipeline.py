"""The pipeline on the smallest tables against plain Python."""

import re
from collections import Counter

import corpus_pipeline
from plumeline.llm import pieces, simhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def good(text):
    words = SPACE.findall(text or "")
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words) >= 50 and 100 * len(repeated) <= 50 * len(words)


def ascii_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_stages_against_plain_python(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kept = {d: t for d, t in docs.items() if good(t)}
    fps = {d: simhash.fingerprint(t) for d, t in kept.items()}
    group = {d: d for d in kept}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    order = sorted(kept)
    for i, a in enumerate(order):
        for b in order[:i]:
            if bin((fps[a] ^ fps[b]) & (1 << 64) - 1).count("1") <= 4 and root(a) != root(b):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    kept = {d: t for d, t in kept.items() if root(d) == d}
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = ascii_words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(len(w) - 9, min(len(w), 1)))}
    lengths = {len(w) for w in windows}

    def leaked(text):
        w = ascii_words(text)
        return any(tuple(w[i:i + n]) in windows for n in lengths for i in range(len(w) - n + 1))

    kept = {d: t for d, t in kept.items() if not leaked(t)}
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    by_stage = []
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf)
        by_stage.append(frame)
    masked = {r.doc_id: r.text for r in by_stage[3].collect()}
    assert set(masked) == set(kept)
    for d, text in masked.items():
        parts = text.split("[secret]")
        assert kept[d].startswith(parts[0]) and kept[d].endswith(parts[-1])
        assert len(parts) > 1 or text == kept[d]
        assert not re.search(r"(?<![0-9a-f])[0-9a-f]{32,}", text)
    assert by_stage[3].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    known = pieces.vocabulary(pieces.MODEL)
    rows = {r.doc_id: r for r in by_stage[4].collect()}
    assert set(rows) == set(kept) and all(r.round_trip for r in rows.values())
    for d in list(rows)[:20]:
        paths = known.encode(masked[d])
        assert (rows[d].n_pieces, rows[d].scores) == (len(paths[0][1]), ",".join(str(s) for s, _ in paths))


def test_run_on_an_empty_table(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
