"""Periodic runs of words: stretches that repeat a short phrase over and over.

A dictionary of basic factors names, for each power of two, the stretches of so
many words: a name at one level is a pair of names of the level below.  Where
the next occurrence of a factor of 2**k words stands at most 2**k words on, and
the one after it just as far, the occurrences form an arithmetic progression
whose difference is proposed as a period.  A period q is met at the level with
q <= 2**k < 2q: there the next occurrence is q words on and nowhere nearer, or
q would not be the smallest period.  Proposals are extended both ways by
comparing factors from the longest down, and equal ones are merged.

A factor that occurs once in its text needs no name, nor do longer ones that
hold it, so prose without repeats costs little beyond its first level.  Texts
are worked on in blocks of `BLOCK_WORDS` words, and each text in one piece: a
block takes about a hundred bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .text import whole

MIN_LENGTH = 6
MIN_REPEATS = 4
BLOCK_WORDS = 1 << 18
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Factors:
    """Names of the repeated factors of each power of two, texts kept apart.

    ``names[k][i]`` is a number of its own below zero if the factor of 2**k
    words at i occurs nowhere else in its text, or leaves it.
    """

    def __init__(self, words: np.ndarray, texts: np.ndarray) -> None:
        self.n = len(words)
        self.names: list[np.ndarray] = []
        self.gaps: list[np.ndarray] = []
        longest = int(np.bincount(texts).max()) if self.n else 0
        live = np.arange(self.n)
        keys = texts * (int(words.max()) + 1) + words if self.n else words
        while len(live):
            live, names = self._level(live, keys)
            half = 1 << (len(self.names) - 1)
            if 2 * half >= longest:
                break
            after = live[live + half < self.n] + half
            after = after[names[after] >= 0]
            live = after[names[after - half] >= 0] - half
            keys = names[live].astype(np.int64) * self.n + names[live + half]

    def _level(self, live: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        place, keys = live[order], keys[order]
        same = keys[1:] == keys[:-1]
        again = np.r_[False, same] | np.r_[same, False]
        names = -1 - np.arange(self.n, dtype=np.int64)
        names[place[again]] = np.cumsum(np.r_[True, ~same])[again]
        gaps = np.zeros(self.n, np.int64)  # words to the next occurrence
        gaps[place[:-1][same]] = place[1:][same] - place[:-1][same]
        self.names.append(names)
        self.gaps.append(gaps)
        return np.sort(place[again]), names

    def proposals(self) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(starts of progressions, factor length, difference) per level."""
        for k, gaps in enumerate(self.gaps):
            reach = 1 << k
            near = np.where((gaps > reach // 2) & (gaps <= reach), gaps, 0)
            at = np.flatnonzero(near)
            at = at[near[at + near[at]] == near[at]]  # two steps of the same length
            # The place before proposes the same run if it has the same difference.
            steps = np.zeros(self.n + 1, np.int64)
            steps[at + 1] = near[at]
            at = at[steps[at] != near[at]]
            yield at, reach, near[at]

    def common(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """Number of equal words from a and b on (way 1) or before them (way -1)."""
        a, b = a.copy(), b.copy()
        begin, top = a.copy(), len(self.names) - 1
        for k in range(top, -1, -1):
            step, names = 1 << k, self.names[k]
            while True:
                left, right = (a, b) if way > 0 else (a - step, b - step)
                inside = (left >= 0) & (right + step <= self.n)
                go = inside & (names[np.where(inside, left, 0)] == names[np.where(inside, right, 0)])
                a[go] += way * step
                b[go] += way * step
                if k < top or not go.any():
                    break
        return np.abs(a - begin)

    def runs(self, min_length: int, repeats: int) -> np.ndarray:
        """Rows (start, length, period) of all maximal runs, by start and period."""
        found = [np.empty((0, 3), np.int64)]
        for at, reach, period in self.proposals():
            if len(at):
                left = self.common(at, at + period, -1)
                right = self.common(at, at + period, 1)
                found.append(np.stack((at - left, left + right + period, period), axis=1))
        runs = np.unique(np.concatenate(found), axis=0)
        runs = runs[runs[:, 1] >= np.maximum(min_length, repeats * runs[:, 2])]
        return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _solve(block: list[list[bytes]], min_length: int, repeats: int) -> tuple[list, list]:
    """Runs and remaining words of each text of a block."""
    sizes = np.array([len(words) for words in block])
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for words in block for w in words),
                      np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    found = Factors(ids, np.repeat(np.arange(len(block)), sizes)).runs(min_length, repeats)
    which = np.searchsorted(ends, found[:, 0], "right")
    cuts = np.searchsorted(which, np.arange(len(block) + 1))
    runs, kept = [], []
    for i, words in enumerate(block):
        mine = found[cuts[i]:cuts[i + 1]] - [ends[i] - sizes[i], 0, 0]
        runs.append([dict(zip(("start", "length", "period"), r)) for r in mine.tolist()])
        if len(mine):
            steps = np.zeros(len(words) + 1, np.int64)
            np.add.at(steps, mine[:, 0] + mine[:, 2], 1)
            np.add.at(steps, mine[:, 0] + mine[:, 1], -1)
            words = [words[j] for j in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
        kept.append(b" ".join(words))
    return runs, kept


def find_runs(df: DataFrame, keep: dict[str, Column], *, text: str | Column = "text",
              min_length: int = MIN_LENGTH, repeats: int = MIN_REPEATS,
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """``keep`` plus ``n_words``, ``runs`` (by start, then period) and ``collapsed``.

    A run is a stretch of words with smallest period q, at least ``min_length``
    words and ``repeats`` periods long, that no neighbouring word extends;
    ``repeats`` is 4 or more, as the levels need.  ``collapsed`` leaves out each
    word that some run holds after its first q words.  A NULL text has no words
    and no runs; rows are worked on one by one, so ties, repeated rows and NULL
    ids are all the same; an empty table gives an empty result.  ``keep`` may
    not name the three added columns.
    """
    if repeats < 4:
        raise ValueError("runs of fewer than four periods are not all proposed")
    taken = {"n_words", "runs", "collapsed"} & set(keep)
    if taken:
        raise ValueError(f"names of added columns cannot be kept: {sorted(taken)}")
    rows = df.select(*[c.alias(k) for k, c in keep.items()], whole(text).cast("binary").alias("_text"))
    schema = T.StructType(rows.schema.fields[:-1]).add("n_words", "long").add(
        "runs", T._parse_datatype_string(_RUNS)).add("collapsed", "binary")
    names, kind = schema.fieldNames(), pa.list_(pa.struct(
        [(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(batch.num_columns - 1), 0
            while at < batch.num_rows:
                block, size, begin = [], 0, at
                while at < batch.num_rows and size < block_words:
                    block.append(texts[at].as_py().split())
                    size += len(block[-1])
                    at += 1
                runs, kept = _solve(block, min_length, repeats)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(begin, at - begin) for c in batch.columns[:-1]),
                     pa.array([len(w) for w in block], pa.int64()), pa.array(runs, kind),
                     pa.array(kept, pa.binary())], names=names)

    return rows.mapInArrow(run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with most periods, exactly: ties go to the smallest start, then period; NULL if none."""
    def better(a: Column, b: Column) -> Column:
        lead = b["length"] * a["period"] - a["length"] * b["period"]
        return F.when(lead > 0, b).otherwise(a)  # runs come by start and period

    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)), better)
