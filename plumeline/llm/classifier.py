"""Quality and toxicity of documents by hierarchical empirical Bayes.

A logistic model reads a document's own evidence: ratios that any junk shows,
and hashed words through a Bernoulli log-odds table.  Sites add theirs: labels
and document scores are summed by host and by path (a section of a host), a
path's rate is shrunk toward its host's and a host's toward the global one, each
with a strength fitted to how much the groups really differ.  The prior log-odds
of a document's path then join the document's evidence.

Documents have no path column: the language stands in for it unless another
column is named.

The model is fitted on a sample of labelled rows of bounded size; every other
count covers the whole corpus and is one grouped aggregation.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .text import written

# At most this many labelled rows train the document model (the bound of the sample).
TRAIN_ROWS = 20_000
# A word needs this many training texts to enter the table.
_MIN_WORD_DOCS = 5
_SYMBOLS = frozenset("#*$%&|<>!@^~=\\{}[]_")
RATIOS = ("log_words", "symbols", "upper", "repeats", "mean_word", "word_spread", "lines", "digits", "bars", "marks")


_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower case."""
    return _LETTERS.findall((text or "").lower())


def ratios(text: str | None) -> list[float]:
    """Shape of a text: lengths, symbols, case and repetition, as bounded numbers."""
    text = text or ""
    words = text.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    lengths = [len(w) for w in words] or [0]
    mean = sum(lengths) / n
    spread = math.sqrt(sum((x - mean) ** 2 for x in lengths) / n)
    symbols = sum(map(text.count, _SYMBOLS))
    letters = max(sum(map(str.isalpha, words)), 0)
    return [math.log1p(len(words)), min(symbols / n, 3.0),
            sum(map(str.isupper, words)) / n, 1 - len(set(words)) / n, min(mean, 20.0), min(spread, 10.0),
            min(text.count("\n") / n, 1.0), sum(map(text.count, "0123456789")) / chars, words.count("|") / n,
            letters / n]


@dataclass(frozen=True)
class Logistic:
    """Standardised features, weights and intercept."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.intercept


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> Logistic:
    """Ridge logistic regression by Newton steps; one class only gives a constant."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    beta = np.zeros(z.shape[1])
    penalty = np.r_[1e-3, np.full(x.shape[1], ridge)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (y - p) - penalty * beta
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        move = np.linalg.solve(hessian, gradient)
        beta = beta + move
        if np.abs(move).max() < 1e-8:
            break
    return Logistic(mean, scale, beta[1:], float(beta[0]))


@dataclass(frozen=True)
class Model:
    """Document model of one label: word log-odds and a logistic on top of them."""

    words: dict[str, float]
    top: Logistic

    def features(self, shape: list[float], tokens: list[str]) -> list[float]:
        """Shape ratios, then mean, largest and smallest word log-odds and the share of strong words."""
        table = self.words
        found = [table[w] for w in tokens if w in table]
        n = max(len(found), 1)
        return shape + [sum(found) / n, max(found, default=0.0), min(found, default=0.0),
                        min(sum([v > 2 for v in found]), 10)]

    def log_odds(self, shapes: list[list[float]], tokens: list[list[str]]) -> np.ndarray:
        return self.top.log_odds(np.array([self.features(r, t) for r, t in zip(shapes, tokens)]))


def fit_document_model(texts: list[str | None], labels: np.ndarray) -> Model:
    """Word table on one half of the sample, logistic on the other, so that neither flatters the other."""
    half = np.arange(len(texts)) % 2 == 0
    seen = {0: Counter(), 1: Counter()}
    for text, label, first in zip(texts, labels, half):
        if first:
            seen[int(label)].update(set(words_of(text)))
    n0, n1 = max(int((half & (labels == 0)).sum()), 1), max(int((half & (labels == 1)).sum()), 1)
    table = {}
    for word in seen[0].keys() | seen[1].keys():
        a, b = seen[1][word], seen[0][word]
        if a + b >= _MIN_WORD_DOCS:
            odds = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
            if abs(odds) > 0.7:
                table[word] = odds
    draft = Model(table, Logistic(np.zeros(1), np.ones(1), np.zeros(1), 0.0))
    rest = [i for i in range(len(texts)) if not half[i]] or list(range(len(texts)))
    x = np.array([draft.features(ratios(texts[i]), words_of(texts[i])) for i in rest])
    return Model(table, fit_logistic(x, labels[rest].astype(float)))


def training_sample(df: DataFrame, labels: DataFrame, label_columns: list[str], *, id: str, text: str,
                    rows: int = TRAIN_ROWS) -> pd.DataFrame:
    """At most ``rows`` labelled documents, chosen by hash of their id."""
    known = labels.select(labels[id].alias("_id"), *[labels[c].cast("int").alias(f"_{c}") for c in label_columns])
    for c in label_columns:
        known = known.filter(F.col(f"_{c}").isin(0, 1))
    total = known.count()
    rate = min(1.0, rows / max(total, 1))
    chosen = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(rate * 1_000_000)) if rate < 1 else known
    texts = df.select(df[id].alias("_id"), df[text].cast("string").alias("_text"))
    picked = texts.join(chosen, "_id").orderBy(F.xxhash64("_id"), "_id", "_text").limit(rows)
    return picked.toPandas()  # bounded by ``rows``


def score(df: DataFrame, keep: dict[str, Column], models: dict[str, Model], *, text: str) -> DataFrame:
    """``keep`` plus ``z_<label>``, the document's own log-odds, over whole texts."""
    rows = df.select(*[c.alias(k) for k, c in keep.items()], df[text].cast("string").alias("_text"))
    schema: StructType = rows.drop("_text").schema
    for label in models:
        schema = schema.add(f"z_{label}", "double")
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = batch.column(batch.num_columns - 1).to_pylist()
                shapes, tokens = [ratios(t) for t in texts], [words_of(t) for t in texts]
                scores = [pa.array(m.log_odds(shapes, tokens)) for m in models.values()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *scores], names=names)

    return rows.mapInArrow(run, schema)


def _shrunk(groups: DataFrame, n: str, hits: str, prior: str, out: str) -> DataFrame:
    """Adds ``out``: hits / n pulled toward ``prior`` with a strength fitted over all groups by moments."""
    p = F.col(prior)
    gap = F.col(hits) / F.col(n) - p
    fit = groups.agg(F.sum(F.col(n)).alias("all"), F.sum(gap * gap * F.col(n)).alias("squares"),
                     F.sum(p * (1 - p)).alias("noise"), F.sum(p * (1 - p) * F.col(n)).alias("unit"))
    # Squares beyond counting noise, per row, against p (1 - p): the share of variance between groups.
    share = (F.col("squares") - F.col("noise")) / F.col("unit")
    strength = F.when((F.col("unit") <= 0) | (share <= 1e-6), F.lit(1e6)).otherwise(
        F.greatest(1 / F.when(share > 0, share) - 1, F.lit(1.0)))
    k = f"{out}_strength"
    return groups.join(F.broadcast(fit.select(F.coalesce(strength, F.lit(1e6)).alias(k)))).withColumn(  # one row
        out, (F.col(hits) + F.col(k) * p) / (F.col(n) + F.col(k)))


def _evidence(label: str) -> Column:
    """What a document adds to its site: its label, else the probability of its own text."""
    return F.coalesce(F.col(f"y_{label}").cast("double"), 1 / (1 + F.exp(-F.col(f"z_{label}"))))


def site_rates(scored: DataFrame, label: str) -> DataFrame:
    """Per (host, path) the global rate, those of host and path, and the sums they come from.

    A labelled document counts with its label, any other with the probability
    of its own evidence.  Partial sums make a host of any size a row per task.
    """
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"),
                                               F.sum(_evidence(label)).alias("hits"))
    paths = written(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("hits").alias("host_hits"))
    total = hosts.agg((F.sum("host_hits") / F.sum("host_n")).alias("global_rate"))
    hosts = hosts.join(F.broadcast(total))  # one row
    hosts = _shrunk(hosts, "host_n", "host_hits", "global_rate", "host_rate")
    hosts = hosts.withColumnRenamed("host", "_host")
    joined = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    return _shrunk(joined, "n", "hits", "host_rate", "path_rate")


def rate_of_others(own: Column) -> Column:
    """Path posterior of a document's site without the document's own evidence ``own``."""
    k = F.col("host_rate_strength")
    host = (F.col("host_hits") - own + k * F.col("global_rate")) / (F.col("host_n") - 1 + k)
    k = F.col("path_rate_strength")
    return (F.col("hits") - own + k * host) / (F.col("n") - 1 + k)


def classify(df: DataFrame, labels: DataFrame, keep: dict[str, Column], *, id: str = "doc_id", text: str = "text",
             host: str = "source", path: str = "lang", label_columns: tuple[str, ...] = ("quality", "toxic"),
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``keep`` plus ``p_<label>`` and, per label, the rates of the document's host and path.

    ``p`` joins the document's own log-odds with how far its path's posterior
    lies from the global rate; for that the posterior is taken without the
    document itself, so no label and no text counts twice.  NULL texts have the
    evidence of an empty text; NULL hosts and paths are groups of their own;
    labels that are not 0 or 1 are left out; without labels every p is one half,
    moved by nothing; repeated rows are scored each; an empty table gives an
    empty result.  ``keep`` may use any names but those of the result's own
    columns, which raise a ValueError.
    """
    names = list(label_columns)
    results = [*[f"p_{c}" for c in names], *[f"{r}_{c}" for c in names for r in ("host", "path")]]
    if taken := set(keep) & set(results):
        raise ValueError(f"names of the result: {sorted(taken)}")
    sample = training_sample(df, labels, names, id=id, text=text, rows=train_rows)
    models = {}
    for label in names:
        if len(sample):
            models[label] = fit_document_model(sample["_text"].tolist(), sample[f"_{label}"].to_numpy())
        else:
            width = len(RATIOS) + 4
            models[label] = Model({}, Logistic(np.zeros(width), np.ones(width), np.zeros(width), 0.0))
    # The caller's columns go by number until the end, so none meets a name of ours.
    columns = {f"_keep{i}": c for i, c in enumerate(keep.values())}
    columns |= {"_id": df[id], "host": df[host].cast("string"), "path": df[path].cast("string")}
    scored = score(df, columns, models, text=text)
    known = labels.groupBy(labels[id].alias("_label_id")).agg(*[
        F.max(F.when(labels[c].isin(0, 1), labels[c])).alias(f"y_{c}") for c in names])
    scored = written(scored.join(known, F.col("_id") == F.col("_label_id"), "left"), "scored")
    odds = lambda c: F.log(F.greatest(c, F.lit(1e-6)) / F.greatest(1 - c, F.lit(1e-6)))
    sums = ("global_rate", "host_n", "host_hits", "host_rate_strength", "n", "hits", "path_rate_strength")
    for label in names:
        rates = written(site_rates(scored, label), "rates").withColumnsRenamed(
            {"host": "_host", "path": "_path", "host_rate": f"host_{label}", "path_rate": f"path_{label}"})
        same = F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
        scored = scored.join(rates, same, "left")
        scored = scored.withColumn(f"p_{label}", 1 / (1 + F.exp(-(
            F.col(f"z_{label}") + odds(rate_of_others(_evidence(label))) - odds(F.col("global_rate"))))))
        scored = scored.drop("_host", "_path", *sums)
    return scored.select(*[F.col(f"_keep{i}").alias(n) for i, n in enumerate(keep)], *results)
