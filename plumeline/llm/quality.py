"""Quality rules per document, and verdicts on the hosts that keep failing them.

Every rule is a column expression over the whole text.  Rule failures are then
counted by host (partial aggregation, so a host with a third of all rows costs
one row per task), each host's failure rate is shrunk by a beta prior whose two
parameters are fitted to the spread of the host rates, and the verdicts are
joined back.  A host with few documents stays near the overall rate, whatever
its own few documents say.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .text import space_words, whole, written


@dataclass(frozen=True)
class Rules:
    """Limits of the document rules and of the host verdict."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbols_per_word: float = 0.5
    min_mean_word: float = 2.0
    max_mean_word: float = 14.0
    max_dup_line_share: float = 0.5
    max_host_rate: float = 0.6


RULES = ("short", "repetitive", "symbols", "word_length", "dup_lines")


def _left(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits)


def _right(x: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, bits)


def _window_keys(words: Column) -> Column:
    """Per 3-word window one sorted long: high bits hash, low bits position.

    As many low bits as the number of words needs, so texts of any length fit.
    """
    bits = F.length(F.bin(F.size(words)))
    windows = F.sequence(F.lit(0), F.size(words) - 3)
    return F.sort_array(F.transform(windows, lambda i: _left(_right(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), bits), bits)
        .bitwiseOR(i.cast("bigint"))))


def _repeated_starts(words: Column, keys: Column) -> Column:
    """Starts of windows whose three words occur again, from neighbours in key order."""
    bits = F.length(F.bin(F.size(words)))
    low = _left(F.lit(1).cast("bigint"), bits) - 1

    def same(a: Column, b: Column) -> Column:
        at, bt = a.bitwiseAND(low).cast("int"), b.bitwiseAND(low).cast("int")
        equal = _right(a, bits) == _right(b, bits)
        for k in range(3):
            equal = equal & (F.get(words, at + k) == F.get(words, bt + k))
        return equal

    last = F.size(keys) - 1
    again = F.filter(keys, lambda x, i: (
        ((i > 0) & same(x, F.get(keys, F.greatest(i - 1, F.lit(0)))))
        | ((i < last) & same(x, F.get(keys, F.least(i + 1, last))))))
    return F.sort_array(F.transform(again, lambda x: x.bitwiseAND(low)))


def _covered(starts: Column) -> Column:
    """Number of positions in the union of [s, s + 3)."""
    state = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(starts, state, lambda acc, s: F.struct(
        (s + 3).alias("end"),
        (acc["n"] + s + 3 - F.greatest(s, acc["end"])).alias("n")), lambda acc: acc["n"])


def document_metrics(df: DataFrame, *, text: str = "text", keep: dict[str, Column]) -> DataFrame:
    """``keep`` plus the counts that the rules look at, one row per row of ``df``."""
    base = df.select(*[c.alias(n) for n, c in keep.items()], whole(text).alias("_text"))
    base = base.withColumn("_words", space_words(F.col("_text")))
    words, body = F.col("_words"), F.col("_text")
    base = base.withColumn("_keys", F.when(F.size(words) >= 3, _window_keys(words)).otherwise(
        F.array().cast("array<bigint>")))
    lines = F.filter(F.split(body, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    base = base.withColumn("_lines", lines)
    return base.select(
        *keep,
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
        (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]+", ""))).cast("bigint")
        .alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _covered(_repeated_starts(words, F.col("_keys"))).alias("n_repeat_words"))


def rule_failures(rules: Rules) -> dict[str, Column]:
    """Per rule of ``RULES``, does the document fail it?"""
    n = F.col("n_words")
    some = n > 0
    mean = F.col("word_chars") / F.greatest(n, F.lit(1))
    return {
        "short": n < rules.min_words,
        "repetitive": 100 * F.col("n_repeat_words") > rules.max_repeat_percent * n,
        "symbols": some & (F.col("n_symbols") > rules.max_symbols_per_word * n),
        "word_length": some & ~mean.between(rules.min_mean_word, rules.max_mean_word),
        "dup_lines": F.col("n_dup_lines") > rules.max_dup_line_share * F.col("n_lines"),
    }


def host_verdicts(failures: DataFrame, rules: Rules) -> DataFrame:
    """Per host: documents, failures, shrunken rate and whether it is rejected.

    The prior has the mean of the host rates and, by moments, their spread
    beyond what counting alone would give; hosts that all look alike get a very
    strong prior (strength at most a million documents).
    """
    hosts = failures.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                         F.sum(F.col("failed").cast("bigint")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(
        F.sum("n_docs").alias("all_docs"), F.sum("n_failed").alias("all_failed"),
        F.count(F.lit(1)).alias("n_hosts"), F.sum(rate * rate * F.col("n_docs")).alias("squares"),
        F.sum(F.lit(1.0) / F.col("n_docs")).alias("inverse"))
    mean = F.col("all_failed") / F.col("all_docs")
    spread = F.greatest(F.col("squares") / F.col("all_docs") - mean * mean, F.lit(0.0))
    noise = mean * (1 - mean) * F.col("n_hosts") / F.col("all_docs")
    between = spread - noise
    strength = F.when(between * 1000000.0 <= mean * (1 - mean), F.lit(1000000.0)).otherwise(
        F.greatest(mean * (1 - mean) / F.when(between > 0, between) - 1, F.lit(0.0)))
    prior = moments.select(mean.alias("prior_rate"), strength.alias("prior_strength"))
    joined = hosts.join(F.broadcast(prior))  # one row
    shrunk = ((F.col("n_failed") + F.col("prior_rate") * F.col("prior_strength"))
              / (F.col("n_docs") + F.col("prior_strength")))
    return joined.select("host", "n_docs", "n_failed", shrunk.alias("host_rate"),
                         (shrunk > rules.max_host_rate).alias("host_rejected"))


def judge(df: DataFrame, keep: dict[str, Column], *, host: str = "source", text: str = "text",
          rules: Rules = Rules()) -> DataFrame:
    """``keep`` plus metrics, failed rules, host verdict and ``kept``.

    ``base_failed`` holds the two hard rules (too short, repetitive); ``kept``
    needs neither of them and a host that is not rejected.  A NULL text has no
    words and fails; a NULL host is a host of its own; repeated rows are judged
    each; an empty table gives an empty result.  ``keep`` names the output
    columns, so other columns of ``df`` never clash with the metrics.
    """
    metrics = document_metrics(df, text=text, keep=keep | {"_host": F.col(host).cast("string")})
    failures = rule_failures(rules)
    judged = metrics.withColumns({f"fails_{r}": failures[r] for r in RULES})
    judged = judged.withColumns({
        "base_failed": F.col("fails_short") | F.col("fails_repetitive"),
        "failed": F.greatest(*[F.col(f"fails_{r}") for r in RULES])})
    judged = written(judged, "quality")  # read twice: counts by host, rows to join
    verdicts = host_verdicts(judged.select(F.col("_host").alias("host"), "failed"), rules)
    joined = judged.join(verdicts, F.col("_host").eqNullSafe(F.col("host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("_host", "host")


def keep_good(df: DataFrame, *, host: str = "source", text: str = "text",
              rules: Rules = Rules()) -> DataFrame:
    """The rows of ``df`` that every rule and host verdict lets through."""
    names = df.columns
    keep = {f"_c{i}": df[c] for i, c in enumerate(names)}
    good = judge(df, keep, host=host, text=text, rules=rules).filter("kept")
    return good.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
