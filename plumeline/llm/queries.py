"""Registered queries of the text operators, one per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (classifier, collocations, decontam, dedup_substrings, html, passages, periodic, pieces, quality, secrets,
               sharding, simhash, warc)
from .oracles import ORACLES  # noqa: F401
from .text import space_words, whole

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: secrets by kind, digest of the base spans, list of all spans."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"))


@query
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its main text and the number of code points in it."""
    found = html.extract(table(spark, sf_dir, "pages"), {"page_id": F.col("page_id"), "url": F.col("url")})
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fingerprint and component of near duplicates."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words inside benchmark windows, items found."""
    docs = table(spark, sf_dir, "documents")
    hits = decontam.find_hits(docs, table(spark, sf_dir, "benchmark"), {"doc_id": F.col("doc_id")})
    return hits.select(
        "doc_id", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))


@query
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: best segmentation, scores of the four best, round trip."""
    return pieces.segment(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: rule counts, hard failures and the verdict with its host's."""
    judged = quality.judge(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: what its archived record says once read back."""
    records = warc.archive_and_read(table(spark, sf_dir, "pages"))
    number = lambda c: F.expr(f"try_cast({c} AS BIGINT)")
    return records.select(number("page_id").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", number("refers_to").alias("refers_to"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, bytes removed, runs removed, digest of what is kept."""
    docs = table(spark, sf_dir, "documents")
    return dedup_substrings.remove_repeats(docs, {"doc_id": F.col("doc_id")})


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size, checksum, shard and slot, under the law `rows`."""
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: probabilities of quality and toxicity and whether it is kept."""
    found = classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                {"doc_id": F.col("doc_id")})
    return found.select(
        "doc_id", "p_quality", "p_toxic", F.col("host_quality").alias("host_rate"),
        F.col("path_quality").alias("path_rate"), (F.col("p_toxic") >= 0.5).alias("toxic"),
        ((F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5)).alias("kept"))


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words of passages that an earlier document holds, digest of what is kept."""
    docs = table(spark, sf_dir, "documents")
    return passages.remove_passages(docs, {"doc_id": docs.doc_id}).drop("repeats")


def _with_planted_runs(text, doc_id):
    """The texts in which every tenth document repeats a stretch of its own words to its end."""
    code = F.crc32(doc_id.cast("string").cast("binary"))
    given = F.struct(space_words(whole(text)).alias("words"), F.floor(code / 10).alias("g"))

    def repeated(x):
        n = F.size(x["words"])
        a = (x["g"] % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + x["g"] % 8)).cast("int")
        return F.when(n == 0, "").otherwise(F.array_join(F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.get(x["words"], F.when(i < a, i).otherwise(a + (i - a) % p))), " "))

    # One element, so that the words are split once and not once for each word.
    planted = F.get(F.transform(F.array(given), repeated), F.lit(0))
    return F.when(code % 10 == 0, planted).otherwise(text)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its runs of repeated phrases, the strongest, and the text without the repeats."""
    docs = table(spark, sf_dir, "documents")
    found = periodic.find_runs(docs, {"doc_id": docs.doc_id}, text=_with_planted_runs(docs.text, docs.doc_id))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", periodic.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: its strongest phrases of two to four words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
