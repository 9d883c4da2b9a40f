import pytest
from pyspark.sql import functions as F

from checks import bronze_files, compare
from checks.registry import ORACLES, QUERIES
from checks.views import view
from __spark_entry__ import entry
from plumeline.config import select_specs
from plumeline.exwas import irls, scan
from plumeline.operators import harmonize
from plumeline.plans import quality, study
from plumeline.sources import bronze, tables


@pytest.fixture(scope="module")
def finished(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("study"))
    source = bronze_files.write_bronze(spark, sf)
    for kind in ("UT/2012/sid_core", "UT/2015/sedd_core", "UT/2013/nested/SASD_core"):
        spark.read.parquet(f"{source}/{kind}").write.parquet(f"{root}/bronze/{kind}")
    tables.write_csv(view(spark, sf, "v_crosswalk"), f"{root}/crosswalk")
    view(spark, sf, "v_exposure").write.parquet(f"{root}/exposures")
    done = study.Study(spark, root, "salt", f"{root}/crosswalk", f"{root}/exposures",
                       years=(1990, 2024), specs=select_specs("overall"),
                       gate=irls.Gate(min_rows=50, min_cases=5))
    study.run(done)
    return done


def test_stages_write_their_tables(finished):
    visits = finished.table("silver/visit_geocoded")
    assert visits.count() == 1500
    months = finished.table("gold/person_month")
    assert months.agg(F.sum("n_visits")).first()[0] == 1500
    assert finished.table("gold/person_month_exposures").count() == months.count()
    assert set(r.metric for r in finished.table("gold/exposure_rollup").select("metric").distinct()
               .collect()) == {"mean"}
    results = finished.table("gold/exwas_result")
    assert results.count() > 20 and results.filter("p_adj_fdr < p_value").count() == 0
    assert quality.test_summary(results).agg(F.sum("n_tests")).first()[0] == results.count()


def test_scan_over_the_rollup_gives_the_same_results(finished):
    direct = finished.table("gold/exwas_result")
    spec = select_specs("overall")[:1]
    rolled = scan.scan(finished.table("gold/person_month"), finished.table("gold/exposure_rollup"),
                       specs=spec, gate=finished.gate)
    def keyed(df):
        return {(r.exposure_id, r.outcome): r for r in df.filter(
            F.col("model_spec_id") == spec[0].id).collect()}
    a, b = keyed(direct), keyed(rolled)
    assert a.keys() == b.keys() and a
    for key in a:
        assert a[key].n == b[key].n and a[key].estimate == pytest.approx(b[key].estimate, abs=1e-9)
        assert a[key].p_adj_fdr == pytest.approx(b[key].p_adj_fdr, abs=1e-9)


def test_rerun_replaces_tables(finished):
    before = finished.table("silver/person").count()
    study.run(finished, ["silver"])
    assert finished.table("silver/person").count() == before
    with pytest.raises(ValueError):
        study.run(finished, ["nonsense"])


def test_result_partitions_are_pruned(finished):
    results = finished.table("gold/exwas_result").filter("strata = 'all' and p_value < 0.5")
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(strata" in plan and "LessThan(p_value,0.5)" in plan


def test_empty_bronze_fails(spark, tmp_path):
    with pytest.raises(Exception):
        bronze.group_by_schema(spark, str(tmp_path))


def test_types_and_years_from_paths():
    assert [bronze.db_type_of(p) for p in ("/a/UT_SEDD.parquet", "/b/sasd/x", "/c/core")] == [
        "SEDD", "SASD", "SID"]
    states = frozenset({"NC"})
    assert bronze.state_year_of("/data/NC/2015/x.parquet", states) == ("NC", 2015)
    assert bronze.state_year_of("/data/UT/x.parquet", states) == (None, None)


def test_numeric_and_text_visit_ids_stay_whole(spark, tmp_path):
    spark.createDataFrame([(1.0, 2.0e11)], "KEY double, VISITLINK double").write.parquet(
        f"{tmp_path}/sid/a")
    spark.createDataFrame([("k9", "p")], "KEY string, VISITLINK string").write.parquet(
        f"{tmp_path}/sid/b")
    got = harmonize.harmonize(spark, str(tmp_path), "s")
    assert sorted(r.visit_id for r in got.collect()) == ["1", "k9"]


def test_entry_runs(spark):
    assert entry(spark).count() == 8


@pytest.mark.parametrize("name", [
    "harmonize_visits", "column_overrides", "person_month", "person_month_exposures",
    "rollup_join", "daily_monthly_metrics", "outcome_adjust", "global_adjust", "top_hits"])
def test_query_equals_its_sql(spark, sf, name):
    assert compare.differences(spark, compare.duck(sf), sf, QUERIES[name], ORACLES[name]) == []
