import numpy as np
import pytest

from plumeline.llm import classifier as C


def test_logistic_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    y = (x[:, 0] + 0.2 * rng.normal(size=500) > 0).astype(float)
    fit = C.fit_logistic(x, y)
    assert ((fit.log_odds(x) > 0) == (y > 0)).mean() > 0.9


def test_held_out_accuracy(spark, sf):
    from pyspark.sql import functions as F
    big = sf.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(4)) == 0
    got = C.classify(docs, labels.filter(~held), {"doc_id": docs.doc_id})
    test = got.join(labels.filter(held).withColumnRenamed("toxic", "y"), "doc_id").toPandas()
    quality = ((test.p_quality >= 0.5) == (test.quality == 1)).mean()
    clean = (test.p_toxic < 0.5)[test.y == 0].mean()
    caught = (test.p_toxic >= 0.5)[test.y == 1].mean()
    print(quality, clean, caught)
    assert quality > 0.98 and clean > 0.98 and caught > 0.9


def test_rates_shrink_against_numpy(spark):
    rows = [("a", "x", 1.0)] * 900 + [("a", "y", 0.0)] * 2 + [("b", "x", 0.0)] * 300 + [(None, None, 1.0)]
    df = spark.createDataFrame([(h, p, int(y), 0.0) for h, p, y in rows],
                               "host string, path string, y_l int, z_l double")
    got = {(r.host, r.path): r for r in C.site_rates(df, "l").collect()}
    overall = sum(y for *_, y in rows) / len(rows)

    def strength(groups):
        n = np.array([g[0] for g in groups], float)
        p = np.array([g[2] for g in groups])
        gap = np.array([g[1] / g[0] for g in groups]) - p
        unit = (p * (1 - p) * n).sum()
        share = ((gap ** 2 * n).sum() - (p * (1 - p)).sum()) / unit
        return 1e6 if share <= 1e-6 else max(1 / share - 1, 1.0)

    hosts = {"a": (902, 900.0, overall), "b": (300, 0.0, overall), None: (1, 1.0, overall)}
    k = strength(list(hosts.values()))
    rate = {h: (x + k * p) / (n + k) for h, (n, x, p) in hosts.items()}
    paths = {("a", "x"): (900, 900.0, rate["a"]), ("a", "y"): (2, 0.0, rate["a"]),
             ("b", "x"): (300, 0.0, rate["b"]), (None, None): (1, 1.0, rate[None])}
    k = strength(list(paths.values()))
    for key, (n, x, p) in paths.items():
        assert got[key].path_rate == pytest.approx((x + k * p) / (n + k))
    assert got["a", "y"].path_rate > 0.1  # two documents do not outweigh the host


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, 1.0), (2, "", "h", "p", 1.0), (2, "", "h", "p", 1.0),
                                  (3, "some words " * 500, "h", None, 0.0)],
                                 "doc_id long, text string, source string, lang string, p_quality double")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 7)], "doc_id long, quality int, toxic int")
    got = C.classify(docs, labels, {"doc_id": docs.doc_id}).collect()
    assert len(got) == 4 and all(0 <= r.p_quality <= 1 for r in got)
    none = C.classify(docs, labels.limit(0), {"doc_id": docs.doc_id}).collect()
    assert {round(r.p_quality, 9) for r in none} == {0.5}
    assert C.classify(docs.limit(0), labels, {"doc_id": docs.doc_id}).count() == 0


def test_a_document_does_not_move_itself(spark):
    rows = [("a", "x", 1, 0.0)] * 3 + [("a", "x", None, 2.0), ("a", "y", 0, 0.0), ("b", "x", 0, 1.0), (None, None, 1, 0.0)]
    df = spark.createDataFrame(rows, "host string, path string, y_l int, z_l double")
    rates = C.site_rates(df, "l").withColumnsRenamed({"host": "_host", "path": "_path"})
    own = C._evidence("l")
    for r in df.join(rates, df.host.eqNullSafe(rates._host) & df.path.eqNullSafe(rates._path)).select(
            "*", own.alias("own"), C.rate_of_others(own).alias("others")).collect():
        evidence = [1 / (1 + np.exp(-z)) if y is None else y for _, _, y, z in rows]
        host = [e for e, row in zip(evidence, rows) if row[0] == r.host]
        path = [e for e, row in zip(evidence, rows) if row[:2] == (r.host, r.path)]
        kh, kp = r.host_rate_strength, r.path_rate_strength
        host_rate = (sum(host) - r.own + kh * r.global_rate) / (len(host) - 1 + kh)
        assert r.others == pytest.approx((sum(path) - r.own + kp * host_rate) / (len(path) - 1 + kp))
        assert r.global_rate == pytest.approx(np.mean(evidence))


def test_names_of_the_caller_stay(spark):
    docs = spark.createDataFrame([(7, "some words", "h", "p")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int")
    taken = {n: docs.doc_id for n in ("host", "path", "_id", "n", "y_toxic", "_text", "global_rate")}
    row = C.classify(docs, labels, taken).first()
    assert all(row[n] == 7 for n in taken)
    with pytest.raises(ValueError, match="p_toxic"):
        C.classify(docs, labels, {"p_toxic": docs.doc_id})
