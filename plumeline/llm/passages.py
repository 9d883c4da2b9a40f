"""Removal of word passages that an earlier document already holds: seed and extend.

A window of `WINDOW` words goes if the same words also start in a document with
a smaller id.  Seeds are winnowed anchors: the smallest hashed `GRAM`-word gram
of a window, so equal windows have equal anchors at equal places, and a text
has one anchor per twenty words or so.

1. Documents are joined on anchors that occur more than once.  Occurrences with
   the same surroundings (all windows filed under the anchor) are one kind; a
   kind knows its smallest document, and all later ones lose those windows.
   A group of copies is thus aggregated before anything is compared.
2. The kinds of an anchor are matched with one leader, the kind of the smallest
   document.  The match is extended word by word to the left and to the right;
   the windows inside are settled, covered where the leader is smaller.
3. Windows that the leader does not hold get a longer seed: the range of places
   a window may take around its anchor is halved, and the words that all
   windows of a half have in common join the key.  Each longer seed has a leader
   of its own, down to the whole window, which leaves nothing open.

So no two occurrences are paired but with a leader, and an occurrence opens at
most one row per window.  Neighbouring covered windows are merged to maximal
repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .text import whole, written

WINDOW = 50
GRAM = 8
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses modulo 2**64
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_KNOWN = 1 << 20  # word hashes remembered at a time
_OPEN = "kind long, first {id}, low int, high int, words binary, seed binary"


class _WordHashes(dict):
    """64-bit hashes of words, computed once for each."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The powers of a base, kept for the next text."""
    if len(_powers.get(base, ())) < n:
        size = max(n, 1 << 14)
        _powers[base] = np.cumprod(np.r_[np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)])
    return _powers[base][:n]


class _Hashed:
    """Prefix hashes of a word sequence under one base; arithmetic wraps modulo 2**64."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        self.prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _power(base, len(values)), out=self.prefix[1:])
        self.inverse = _power(pow(base, -1, 1 << 64), len(values) + 1)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


def anchors(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, ...] | None:
    """(place of the anchor, first window, last window, anchor, two hashes of all windows)."""
    windows = len(words) - window + 1
    if windows <= 0:
        return None
    values = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    text = _Hashed(values, _BASES[0])
    at = np.arange(len(words) - gram + 1)
    grams = text.span(at, at + gram)
    mixed = (grams ^ (grams >> np.uint64(29))) * _MIX
    mixed ^= mixed >> np.uint64(32)
    # The leftmost smallest gram of each window, by doubling.
    reach, width, best = window - gram + 1, 1, at
    while 2 * width <= reach:
        a, b = best[:len(best) - width], best[width:]
        best = np.where(mixed[b] < mixed[a], b, a)
        width *= 2
    a, b = best[:windows], best[reach - width:reach - width + windows]
    best = np.where(mixed[b] < mixed[a], b, a)
    first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    last = np.r_[first[1:] - 1, windows - 1]
    pos = best[first]
    other = _Hashed(values, _BASES[1])
    return (pos, first, last, mixed[pos].view(np.int64), text.span(first, last + window).view(np.int64),
            other.span(first, last + window).view(np.int64))


def _places(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """One row per anchor of every text of ``rows`` (_doc, _text): windows from pos - high to pos - low."""
    names = ["_doc", "pos", "low", "high", "anchor", "around", "around2"]
    schema = T.StructType([rows.schema["_doc"]]).add("pos", "long").add("low", "integer").add("high", "integer")
    for name in names[4:]:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, found = [], []
            for i, t in enumerate(batch.column(1)):
                if (a := anchors(t.as_py().split(), window, gram)) is not None:
                    which.append(np.full(len(a[0]), i))
                    found.append(a)
            if found:
                pos, first, last, *keys = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(which))), pa.array(pos),
                     pa.array((pos - last).astype(np.int32)), pa.array((pos - first).astype(np.int32)),
                     *map(pa.array, keys)], names=names)

    return rows.select("_doc", "_text").mapInArrow(run, schema)


def _anchor_hashes(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [a[3] for t in batch.column(0) if (a := anchors(t.as_py().split(), window, gram)) is not None]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["anchor"])

    return rows.select("_text").mapInArrow(run, "anchor long")


def _seed(words: list[bytes], low: int, high: int) -> bytes:
    return xxhash.xxh3_128_digest(b"%d %d " % (low, high) + b" ".join(words))


def _opened(rows: DataFrame, kinds: DataFrame, window: int, id_type: str) -> DataFrame:
    """The words around one occurrence of each kind, fetched from its text."""
    wanted = kinds.groupBy("_doc").agg(F.collect_list(F.struct("kind", "pos", "low", "high", "anchor")).alias("_at"))
    joined = rows.join(wanted, "_doc").select("_doc.id", "_text", "_at")
    schema = _OPEN.format(id=id_type)
    names = T._parse_datatype_string(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, at = batch.column(1)[i].as_py().split(), batch.column(2)[i].as_py()
                parts = [b" ".join(words[a["pos"] - a["high"]:a["pos"] - a["low"] + window]) for a in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a["kind"] for a in at], pa.int64()), batch.column(0).take(pa.array([i] * len(at))),
                     pa.array([a["low"] for a in at], pa.int32()), pa.array([a["high"] for a in at], pa.int32()),
                     pa.array(parts, pa.binary()),
                     pa.array([a["anchor"].to_bytes(8, "little", signed=True) for a in at], pa.binary())],
                    names=names)

    return joined.mapInArrow(run, schema)


def extended(mine: list[bytes], at: int, other: list[bytes], other_at: int, gram: int) -> tuple[int, int]:
    """Equal words before the anchors at ``at`` and ``other_at``, and after them."""
    left = 0
    while left < min(at, other_at) and mine[at - 1 - left] == other[other_at - 1 - left]:
        left += 1
    i, j = at + gram, other_at + gram
    right = 0
    while i + right < len(mine) and j + right < len(other) and mine[i + right] == other[j + right]:
        right += 1
    return left, right


def _matched(pairs: DataFrame, half: tuple[tuple[int, int], ...], window: int, gram: int, id_type: str) -> DataFrame:
    """Covered ranges (seed is NULL) and rows still open, under the seeds of the ranges in ``half``."""
    schema = _OPEN.format(id=id_type)
    names = T._parse_datatype_string(schema).fieldNames()
    room = window - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, source, out = batch.column(1), [], []
            columns = [batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5, 6, 7, 8)]
            for i, (kind, low, high, words, smaller, l_low, l_high, l_words) in enumerate(zip(*columns)):
                mine = words.split(b" ")
                if words == l_words and (low, high) == (l_low, l_high):
                    left, right = high, room
                else:
                    left, right = extended(mine, high, l_words.split(b" "), l_high, gram)
                begin, end = max(low, room - right, l_low), min(high, left, l_high)
                if begin <= end:
                    if smaller:
                        source.append(i)
                        out.append((kind, begin, end, None, None))
                    rest = ((low, begin - 1), (end + 1, high))
                else:
                    rest = ((low, high),)
                for a, b in rest:
                    for h_low, h_high in half:
                        x, y = max(a, h_low), min(b, h_high)
                        if x <= y:
                            source.append(i)
                            out.append((kind, x, y, b" ".join(mine[high - y:high - x + window]), _seed(
                                mine[high - h_low:high - h_high + window], h_low, h_high)))
            if out:
                kind, low, high, words, seed = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind, pa.int64()), firsts.take(pa.array(source)), pa.array(low, pa.int32()),
                     pa.array(high, pa.int32()), pa.array(words, pa.binary()), pa.array(seed, pa.binary())], names=names)

    return pairs.mapInArrow(run, schema)


def _halves(ranges: tuple[tuple[int, int], ...]) -> tuple[tuple[int, int], ...]:
    out = []
    for a, b in ranges:
        out += [(a, b)] if a == b else [(a, (a + b) // 2), ((a + b) // 2 + 1, b)]
    return tuple(out)


def _covered_kinds(opened: DataFrame, window: int, gram: int, id_type: str) -> DataFrame:
    """(kind, low, high): windows of a kind that a kind with a smaller document holds too."""
    ranges = ((0, window - gram),)
    opened = written(opened, "seeds")
    covered = opened.filter("kind is null").select("kind", "low", "high")
    while not opened.isEmpty():
        leader = F.min_by(F.struct("kind", "first", "low", "high", "words"), F.struct("first", "kind"))
        leaders = opened.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), leader.alias("leader"))
        # Written, so that the join has plain shuffles on both sides and can split a hot seed.
        leaders = written(leaders.filter("n > 1").select("seed", "leader"), "leaders")
        # Two ranges of one kind may stand under one seed; the second stays open for the next.
        pairs = opened.join(leaders, "seed").filter("kind != leader.kind or low != leader.low").select(
            "kind", "first", "low", "high", "words", F.col("leader.first") < F.col("first"),
            "leader.low", "leader.high", "leader.words")
        pairs = pairs.toDF("kind", "first", "low", "high", "words", "smaller", "l_low", "l_high", "l_words")
        last = all(a == b for a, b in ranges)
        ranges = _halves(ranges)
        found = written(_matched(pairs, () if last else ranges, window, gram, id_type), "matches")
        covered = covered.union(found.filter("seed is null").select("kind", "low", "high"))
        opened = found.filter("seed is not null")
    return covered


def repeated_spans(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(_doc, first, last): starts of windows that begin in a smaller document too, for (_doc, _text).

    ``_doc`` is a struct of the id and a mark that tells texts of one id apart.
    """
    id_type = rows.schema["_doc"].dataType["id"].dataType.simpleString()
    rows = rows.filter("_doc.id is not null")
    counted = _anchor_hashes(rows, window, gram).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    twice = written(counted.filter("n > 1").select("anchor"), "twice")
    places = written(_places(rows, window, gram).join(twice, "anchor"), "places")

    key = ["anchor", "around", "around2", "low", "high"]
    kinds = places.groupBy(*key).agg(F.min(F.struct("_doc.id", "_doc", "pos")).alias("least"),
                                     F.max("_doc.id").alias("largest"))
    kinds = written(kinds.select(F.monotonically_increasing_id().alias("kind"), *key, "least._doc", "least.pos",
                                 F.col("least.id").alias("first"), "largest"), "kinds")
    several = kinds.groupBy("anchor").agg(F.min("first").alias("a"), F.max("first").alias("b"),
                                          F.count(F.lit(1)).alias("n"))
    several = written(several.filter("n > 1 and a < b").select("anchor"), "several")
    opened = _opened(rows, kinds.join(several, "anchor"), window, id_type)
    covered = _covered_kinds(opened, window, gram, id_type).groupBy("kind").agg(
        F.collect_set(F.struct("low", "high")).alias("ranges"))

    # Later documents of a kind lose all of its windows, its first document the covered ones.
    copied = written(kinds.filter("first < largest").select(*key, "first"), "copied")
    later = places.join(copied, key).filter(F.col("_doc.id") > F.col("first")).select(
        "_doc", (F.col("pos") - F.col("high")).alias("first"), (F.col("pos") - F.col("low")).alias("last"))
    part = written(kinds.join(covered, "kind").select(*key, "first", "ranges"), "covered")
    earliest = places.join(part, key).filter(F.col("_doc.id") == F.col("first")).select(
        "_doc", "pos", F.explode("ranges").alias("r")).select(
        "_doc", (F.col("pos") - F.col("r.high")).alias("first"), (F.col("pos") - F.col("r.low")).alias("last"))
    return written(later.union(earliest), "passages")


def remove_passages(df: DataFrame, keep: dict[str, Column], *, id: str = "doc_id", text: str = "text",
                    window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """``keep`` plus ``n_words, n_removed, repeats`` (first and last word) and ``kept_sha256`` (and ``kept_text``).

    A word goes if any window of ``window`` words around it also starts in a
    row with a smaller id.  Rows of equal ids do not remove each other's words;
    a row without an id keeps all of its words and removes none.  A NULL text
    has no words; shorter texts stay whole; an empty table gives an empty
    result.  ``keep`` may not name the added columns.
    """
    taken = {"n_words", "n_removed", "repeats", "kept_sha256", "kept_text"} & set(keep)
    if taken:
        raise ValueError(f"names of added columns cannot be kept: {sorted(taken)}")
    rows = df.select(*[c.alias(k) for k, c in keep.items()], df[id].alias("_id"),
                     whole(df[text]).cast("binary").alias("_text"))
    rows = rows.withColumn("_doc", F.struct(F.col("_id").alias("id"), F.xxhash64("_text").alias("mark"))).drop("_id")
    spans = repeated_spans(rows.select("_doc", "_text"), window, gram)
    by_doc = spans.groupBy("_doc").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("_spans"))
    joined = rows.join(by_doc, "_doc", "left").select(*keep, "_text", "_spans")
    schema = joined.drop("_text", "_spans").schema
    for field in T._parse_datatype_string("n_words long, n_removed long, repeats array<struct<first:long,last:long>>, "
                                          "kept_sha256 string, kept_text binary"):
        schema = schema.add(field)
    names = schema.fieldNames()
    pair = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, spans in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
                words, runs = t.as_py().split(), []
                for s in spans.as_py() or ():
                    begin, end = s["first"], s["last"] + window
                    if runs and begin <= runs[-1][1]:  # touching repeats are one
                        runs[-1][1] = max(end, runs[-1][1])
                    else:
                        runs.append([begin, end])
                kept, at = [], 0
                for begin, end in runs:
                    kept += words[at:begin]
                    at = end
                rest = b" ".join(kept + words[at:])
                out.append((len(words), sum(e - b for b, e in runs), [{"first": b, "last": e - 1} for b, e in runs],
                            hashlib.sha256(rest).hexdigest(), rest if with_text else None))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (
                pa.int64(), pa.int64(), pair, pa.string(), pa.binary()))]
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=names)

    found = joined.mapInArrow(cut, schema)
    return found.withColumn("kept_text", F.col("kept_text").cast("string")) if with_text else found.drop("kept_text")
