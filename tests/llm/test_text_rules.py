"""Quality rules, decontamination and secrets against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from plumeline.llm import decontam, quality, secrets

SCHEMA = "doc_id long, text string, source string, n_words long, kept string, _text string"


def docs(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, sources[i] if sources else f"s{i % 2}", i, "x", "y")
                                  for i, t in enumerate(texts)], SCHEMA)


# ---- quality -----------------------------------------------------------------------
def metrics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(again))


QUALITY = [None, "", " \n\t\x0b", "one", "a b c a b c", "x " * 5000, "é è x #*$ |\n\n dup\ndup \ndup", "a a a",
           " ".join(f"w{i}" for i in range(60)), "w " + "\x1c" + " z", "a b a b a b a", "ab c a bc ab c"]


def test_metrics_against_python(spark):
    rng = random.Random(2)
    texts = QUALITY + [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 80))) for _ in range(60)]
    df = docs(spark, texts)
    got = {r.id: tuple(r)[1:] for r in quality.document_metrics(df, keep={"id": df.doc_id}).select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: metrics(t) for i, t in enumerate(texts)}


def test_host_verdicts_shrink(spark):
    fine = " ".join(f"w{i}" for i in range(60))
    texts = ["short"] * 300 + [fine] * 20 + [fine] * 300 + ["short"] * 2 + [fine] * 3 + [fine]
    sources = ["bad"] * 320 + ["good"] * 300 + ["tiny"] * 5 + [None]
    df = docs(spark, texts, sources)
    judged = quality.judge(df, {"id": df.doc_id, "where": df.source}).collect()
    by = defaultdict(set)
    for r in judged:
        by[r.where].add((r.base_failed, r.kept))
    assert len(judged) == len(texts)
    assert by["bad"] == {(True, False), (False, False)}  # its few good texts go with it
    assert by["good"] == {(False, True)} and by[None] == {(False, True)}
    assert by["tiny"] == {(True, False), (False, True)}
    rates = {r.where: (r.n_docs, r.n_failed, r.host_rate) for r in judged}
    n = sum(v[0] for v in rates.values())
    mu = sum(v[1] for v in rates.values()) / n
    spread = sum((f / d) ** 2 * d for d, f, _ in rates.values()) / n - mu * mu
    gap = spread - mu * (1 - mu) * len(rates) / n
    k = max(mu * (1 - mu) / gap - 1, 0)
    for d, f, rate in rates.values():
        assert math.isclose(rate, (f + mu * k) / (d + k), rel_tol=1e-9)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == 304
    assert quality.keep_good(df.limit(0)).count() == 0
    assert quality.judge(df.limit(2).union(df.limit(2)), {"id": df.doc_id}).count() == 4


# ---- decontamination -----------------------------------------------------------------
def ascii_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        w = ascii_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i:i + n])].add("" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, found = ascii_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((len(w), sorted(hit), sorted(found)))
    return out


def test_hits_against_python(spark):
    rng = random.Random(3)
    vocabulary = ["alpha", "É", "é", "beta2", "x", "longerword", "K", "K", "İ", "zz"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, make(rng.randrange(11, 30))) for i in range(12)]
    items += [(20, "Only three WORDS"), (21, "É"), (22, None), (23, "..."), (20, "again other text"), (None, "null item")]
    texts = [None, "", "É x", "é x", "only, THREE words!", "null ITEM", "a" * 50]
    for _ in range(40):
        text = make(rng.randrange(0, 40))
        if rng.random() < 0.5:
            text += " " + items[rng.randrange(12)][1].upper().replace(" ", ", ") + " " + make(5)
        texts.append(text)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    df = docs(spark, texts + texts[:3])
    wanted = brute_hits(texts + texts[:3], items)
    for limit in (decontam.MAX_SET, 0):  # 0: windows joined by a shuffle
        found = decontam.find_hits(df, bench, {"id": df.doc_id}, max_set=limit).collect()
        assert {r.id: (r.n_words, r.hit_words, r["items"]) for r in found} == dict(enumerate(wanted))
        clean = decontam.drop_contaminated(df, bench, max_set=limit)
        assert clean.columns == df.columns
        assert sorted(r.doc_id for r in clean.collect()) == [i for i, w in enumerate(wanted) if not w[1]]
    nothing = decontam.find_hits(df, bench.limit(0), {"id": df.doc_id})
    assert nothing.filter("size(hit_words) > 0 or size(items) > 0").count() == 0 and nothing.count() == len(wanted)
    assert decontam.find_hits(df.limit(0), bench, {"id": df.doc_id}).count() == 0


# ---- secrets ------------------------------------------------------------------------
ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?i:passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_spans(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    base = sorted(out)
    for rank, cls in enumerate(secrets.CLASSES, 3):
        inside = "[" + re.escape(cls.alphabet) + "]"
        for m in re.finditer(f"{inside}{{{cls.window},}}", text):
            run = m[0]
            if not all(re.search(n, run) for n in cls.needs) or any(re.search(a, run) for a in secrets.ALLOWED):
                continue
            merged = []
            for i in range(len(run) - cls.window + 1):
                counts = Counter(run[i:i + cls.window])
                total = sum(round(c * math.log2(c) * 1e6) for c in counts.values())
                if total <= secrets.entropy_limit(cls):
                    if merged and i <= merged[-1][1]:
                        merged[-1][1] = i + cls.window
                    else:
                        merged.append([i, i + cls.window])
            out += [(m.start() + a, rank, m.start() + b, cls.kind) for a, b in merged]
    return base, sorted(out)


def test_spans_against_python(spark):
    rng = random.Random(5)
    pick = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    base64 = secrets.CLASSES[1].alphabet
    texts = [None, "", "token", "é token: '12345678' x", "token=token=abcdefgh", "Api_Key = short", "secret: passwd: abcdefghij",
             "AKIA" + "A" * 11, "AKIA" + "B2" * 8 + "é", "f" * 32, "g" + "0af" * 20, "-" * 60, "exampleAb1" * 6,
             "123e4567-e89b-12d3-a456-426614174000", "/usr/local/share/Abc123def456ghi789jkl0"]
    for _ in range(60):
        texts.append(" ".join(rng.choice([pick("0123456789abcdef", rng.randrange(1, 70)), pick(base64, rng.randrange(1, 90)),
                                          "token: " + pick(base64, rng.randrange(1, 20)), "été", "AKIA" + pick("AZ09", 14),
                                          pick("ab", 30) + pick(base64, 40) + pick("ab1B", 60) + pick(base64, 30)])
                              for _ in range(rng.randrange(1, 6))))
    df = docs(spark, texts)
    got = {r.id: ([tuple(s) for s in r.base], [tuple(s) for s in r.spans])
           for r in secrets.find_secrets(df, {"id": df.doc_id}).collect()}
    assert got == {i: brute_spans(t) for i, t in enumerate(texts)}
    masked = secrets.redact(df)
    assert masked.columns == df.columns
    for r in masked.collect():
        text, at, out = texts[r.doc_id], 0, ""
        for start, _, end, _ in brute_spans(text)[1]:
            if end > at:
                out += (text[at:start] + "[secret]") if start >= at else ""
                at = end
        assert r.text == (None if text is None else out + text[at:])
    assert secrets.find_secrets(df.limit(0), {"id": df.doc_id}).count() == 0


def test_long_run_is_scanned_whole(spark):
    rng = random.Random(6)
    text = "".join(rng.choice(secrets.CLASSES[1].alphabet) for _ in range(20_000))
    df = docs(spark, [text])
    spans = secrets.find_secrets(df, {"id": df.doc_id}).first().spans
    assert any(s.kind == "entropy_base64" and s.end - s.start > 1000 for s in spans)
