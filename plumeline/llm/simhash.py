"""SimHash near-duplicates: bit-sliced comparison inside blocks, then components.

Fingerprints within radius 4 agree on at least two of six blocks of bits, so
every pair of blocks is one table of buckets.  Inside a run of buckets the
fingerprints are stored as 64 vertical bit planes.  XOR of a plane with itself
shifted by s rows compares every row with the s-th row after it at once;
carry-save counters add the planes up, and a run is abandoned as soon as all
its distances exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .text import written

RADIUS = 4
SHINGLE = 4
SEED = 42
# Blocks of bits (offset, width); two more than the radius.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
PAIRS = tuple(combinations(range(len(BLOCKS)), 2))
# A bucket with more fingerprints is cut once more, see `_bucketed`.
HOT_BUCKET = 4096
CUTS = 2
_RUN = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit b is set if it is set in over half of the shingles' hashes; no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at:at + (1 << 16)].tolist(), ends[at:at + (1 << 16)].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.dtype("<u8"))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(chosen.view(np.dtype("<i8"))[0])


def fingerprints(df: DataFrame, keep: dict[str, Column], *, text: str = "text") -> DataFrame:
    """``keep`` plus ``fp``, the fingerprint as a signed long.

    A NULL text has no words.  Texts stream through in batches; each is hashed
    whole.
    """
    rows = df.select(*[c.alias(k) for k, c in keep.items()], F.col(text).cast("string").alias("_text"))
    names = [*keep, "fp"]
    schema = rows.drop("_text").withColumn("fp", F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, fps], names=names)

    return rows.mapInArrow(run, schema)


class _Run:
    """Rows of whole buckets with their bit planes, compared shift by shift."""

    def __init__(self, fps: np.ndarray, buckets: np.ndarray) -> None:
        self.n = len(fps)
        self.buckets = buckets
        bits = np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        packed = np.packbits(bits.T, axis=1, bitorder="little")
        self.planes = [int.from_bytes(row.tobytes(), "little") for row in packed]

    def within(self, shift: int, radius: int) -> np.ndarray:
        """Rows i whose row i + shift is in the same bucket and within the radius."""
        same = self.buckets[:-shift] == self.buckets[shift:]
        live = int.from_bytes(np.packbits(same, bitorder="little").tobytes(), "little")
        counters = [0] * radius.bit_length()
        over = 0
        for k, plane in enumerate(self.planes):
            carry = plane ^ (plane >> shift)
            for i, counter in enumerate(counters):
                counters[i], carry = counter ^ carry, counter & carry
            over |= carry
            if k % 8 == 7 and not live & ~self._beyond(counters, over, radius):
                return np.empty(0, np.int64)
        near = live & ~self._beyond(counters, over, radius)
        raw = near.to_bytes((self.n + 7) // 8, "little")
        return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little"))

    @staticmethod
    def _beyond(counters: list[int], over: int, radius: int) -> int:
        """Bits of the rows whose count is larger than the radius."""
        equal, larger = -1, 0
        for i in reversed(range(len(counters))):
            if radius >> i & 1:
                equal &= counters[i]
            else:
                larger |= equal & counters[i]
                equal &= ~counters[i]
        return over | larger


def near_links(fps: np.ndarray, buckets: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links inside buckets (rows sorted by bucket)."""
    parent = np.arange(len(fps))
    rows, forest = np.arange(len(fps)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    shift = 1
    while True:
        # Only buckets with more rows than the shift still have pairs to offer.
        _, sizes = np.unique(buckets[rows], return_counts=True)
        rows = rows[np.repeat(sizes > shift, sizes)]
        if not len(rows):
            return forest
        run, until = _Run(fps[rows], buckets[rows]), max(2 * shift, 4)
        while shift < min(until, len(rows)):
            for i in run.within(shift, radius).tolist():
                a, b = root(rows[i]), root(rows[i + shift])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    forest.append((int(fps[rows[i]]), int(fps[rows[i + shift]])))
            shift += 1


def _block(fp: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _bucketed(fps: DataFrame, hot: int) -> DataFrame:
    """(fp, bucket): one row per pair of blocks, hot buckets cut by their other bits.

    Two fingerprints of a bucket that are within the radius differ in at most
    four of the five parts that the remaining bits fall into, so each hot bucket
    becomes five families of smaller ones.  After two cuts a bucket agrees on
    some forty bits, and what is left of it is compared in one task.
    """
    fp = F.col("fp")

    def mask(i: int, j: int) -> int:
        return sum(((1 << w) - 1) << o for o, w in (BLOCKS[i], BLOCKS[j]))

    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = F.array(*[F.lit(signed(mask(i, j))).cast("bigint") for i, j in PAIRS])
    rows = fps.select("fp", F.explode(masks).alias("mask"))
    done = None
    for level in range(CUTS + 1):
        rows = rows.select("fp", "mask", fp.bitwiseAND(F.col("mask")).alias("key"))
        if level == CUTS:
            break
        large = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot)
        large = written(large.select("mask", "key"), "hot-buckets")
        if large.isEmpty():
            break
        rest = rows.join(large, ["mask", "key"], "left_anti").select("fp", "mask", "key")
        done = rest if done is None else done.union(rest)
        # The free bits in order are dealt to five parts; each part joins the mask in turn.
        free = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function(
            "getbit", F.col("mask"), b) == 0)
        part = lambda k: F.aggregate(
            F.filter(free, lambda b, i: i % (RADIUS + 1) == k), F.col("mask"),
            lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)))
        finer = F.array(*[part(k) for k in range(RADIUS + 1)])
        rows = rows.join(large, ["mask", "key"]).select("fp", F.explode(finer).alias("mask"))
    return rows if done is None else done.union(rows)


def links(fps: DataFrame, *, hot: int = HOT_BUCKET) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints of ``fps`` as all close pairs would.

    Every bucket gives a spanning forest of its close pairs, so the number of
    links stays below the number of bucket rows, however many pairs there are.
    """
    rows = _bucketed(fps, hot).select("fp", F.xxhash64("mask", "key").alias("bucket"))
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def close(last: bool) -> Iterator[pa.RecordBatch]:
            fps = np.concatenate([f for f, _ in held])
            buckets = np.concatenate([b for _, b in held])
            # The last bucket may go on in the next batch.
            cut = len(fps) if last else int(np.searchsorted(buckets, buckets[-1]))
            held[:] = [(fps[cut:], buckets[cut:])]
            found, at = [], 0
            while at < cut:
                end = min(at + _RUN, cut)
                end = min(int(np.searchsorted(buckets, buckets[end - 1], "right")), cut)
                found += near_links(fps[at:end], buckets[at:end])
                at = end
            u, v = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(f) for f, _ in held) >= 1 << 14:
                yield from close(False)
        if held:
            yield from close(True)

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(df: DataFrame, keep: dict[str, Column], *, id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``keep`` plus ``fp`` and ``component_id``, the smallest id reachable over links.

    NULL texts have fingerprint zero and are linked like any other; a NULL id
    never names a component unless all of its ids are NULL; repeated rows share
    a component; an empty table gives an empty result.
    """
    rows = written(fingerprints(df, keep | {"_id": df[id]}, text=text), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("_id").alias("first_id")), "classes")
    roots = components(links(classes.select("fp")))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select(*keep, "fp", "component_id")


def keep_one(df: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id.

    Rows that repeat in every column count as one row.
    """
    mark = F.xxhash64(*[df[c] for c in df.columns])
    return keep_first(df, near_duplicates(df, {"_key": df[id], "_mark": mark}, id=id, text=text), "component_id", id=id)


def keep_first(df: DataFrame, found: DataFrame, group: str, *, id: str = "doc_id") -> DataFrame:
    """The row of ``df`` with the smallest id of each ``group`` of ``found`` (_key, _mark: id and hash of a row)."""
    names = df.columns
    mark = F.xxhash64(*[df[c] for c in names])
    best = found.groupBy(group).agg(F.min(F.struct(
        F.col("_key").isNull().alias("unknown"), "_key", "_mark")).alias("best"))
    best = written(best.select(F.col("best._key").alias("_key"), F.col("best._mark").alias("_mark")), "kept")
    rows = df.select(*[df[c].alias(f"_c{i}") for i, c in enumerate(names)],
                     df[id].alias("_row_key"), mark.alias("_row_mark"))
    same = F.col("_row_key").eqNullSafe(F.col("_key")) & (F.col("_row_mark") == F.col("_mark"))
    chosen = rows.join(best, same, "left_semi")
    repeated = found.groupBy("_key", "_mark").count().filter("count > 1")
    repeated = written(repeated.select("_key", "_mark"), "repeated")
    if not repeated.isEmpty():
        twice = chosen.join(repeated, same, "left_semi").dropDuplicates(["_row_key", "_row_mark"])
        chosen = chosen.join(repeated, same, "left_anti").unionByName(twice)
    return chosen.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
