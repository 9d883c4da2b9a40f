"""Removal of byte strings of a given length that occur more than once.

Every window of ``LENGTH`` bytes is filed under its anchor, the smallest hashed
``ANCHOR``-gram inside it; equal windows have equal anchors at equal offsets.  A
text has one anchor per seventy bytes or so, and only anchors travel:

1. anchors are counted, and those that occur once are done;
2. occurrences of an anchor whose whole surroundings (all windows filed under
   it) have equal hashes are copies: all of their windows repeat;
3. for the others the surroundings are fetched, one of each kind, and the
   windows of an anchor are suffix-sorted by `suffix`, offset by offset;
   neighbours with a common extension of ``LENGTH`` are repeats, bytes verified;
4. an anchor with very many surroundings is dealt to several sorts, whose
   classes are then merged by aggregation over the window's hashes.

A group of copies is aggregated before any shuffle by anchor, and joins on
anchors carry a few numbers per row, so a hot passage is split like any key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .suffix import Hashed, equal_neighbours, sort_suffixes
from .text import whole, written

LENGTH = 200
ANCHOR = 64
# Anchors with more kinds of surroundings are sorted in blocks of about this many.
BLOCK = 4096
_SEGMENT = 1 << 20  # bytes hashed at a time
# Low bits hold a position; a segment and the window that overlaps its end fit.
_LOW = np.uint64((1 << 22) - 1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_ANCHORS = "array<struct<pos:bigint,lo:int,hi:int,anchor:bigint,around:bigint>>"


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor position, first window, last window, anchor hash, hash of all windows)."""
    windows = len(data) - length + 1
    if windows <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    if len(data) - gram > int(_LOW):
        raise ValueError(f"{len(data)} bytes have more positions than the low bits hold")
    text = Hashed(data)
    at = np.arange(len(data) - gram + 1)
    grams = text.hash(at, gram)
    mixed = (grams ^ (grams >> np.uint64(29))) * _MIX
    mixed ^= mixed >> np.uint64(32)
    # Upper bits order the grams, lower bits make the leftmost of equals win.
    least = (mixed & ~_LOW) | at.astype(np.uint64)
    reach, width = length - gram + 1, 1
    while 2 * width <= reach:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[:windows], least[reach - width:reach - width + windows])
    chosen = (least & _LOW).astype(np.int64)
    lo = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    hi = np.r_[lo[1:] - 1, windows - 1]
    pos = chosen[lo]
    around = text.hash(lo, hi + length - lo) ^ ((hi - lo).astype(np.uint64) << np.uint64(48))
    around ^= (pos - lo).astype(np.uint64) << np.uint64(32)
    return pos, lo, hi, mixed[pos].view(np.int64), around.view(np.int64)


def _text_anchors(data: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of a text of any size, segment by segment; segments overlap by a window less one."""
    whole_text = np.frombuffer(data, np.uint8)
    for begin in range(0, max(len(data) - length + 1, 1), _SEGMENT):
        found = anchors(whole_text[begin:begin + _SEGMENT + length - 1], length, gram)
        pos, lo, hi, anchor, around = found
        if len(pos):
            yield pos + begin, lo - pos, hi - pos, anchor, around


def _find(rows: DataFrame, only_hash: bool, length: int, gram: int) -> DataFrame:
    """One row per anchor of every text of ``rows`` (_doc, _text)."""
    if only_hash:
        def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [a[3] for t in batch.column(0) for a in _text_anchors(t.as_py().encode(), length, gram)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["anchor"])

        return rows.select("_text").mapInArrow(hashes, "anchor long")

    names = ["_doc", "pos", "lo", "hi", "anchor", "around"]
    schema = T.StructType([rows.schema["_doc"]]).add("pos", "long").add("lo", "integer").add("hi", "integer") \
        .add("anchor", "long").add("around", "long")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = batch.columns
            which, found = [], []
            for i, t in enumerate(texts):
                for a in _text_anchors(t.as_py().encode(), length, gram):
                    which.append(np.full(len(a[0]), i))
                    found.append(a)
            if found:
                pos, lo, hi, anchor, around = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [docs.take(pa.array(np.concatenate(which))), pa.array(pos), pa.array(lo.astype(np.int32)),
                     pa.array(hi.astype(np.int32)), pa.array(anchor), pa.array(around)], names=names)

    return rows.select("_doc", "_text").mapInArrow(places, schema)


def _surroundings(rows: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """The bytes around one occurrence of each kind, fetched from its text."""
    wanted = kinds.groupBy("_doc").agg(F.collect_list(F.struct(
        "pos", "lo", "hi", "anchor", "block", "blocks", "n")).alias("_at"))
    joined = rows.join(wanted, "_doc").select("_doc", "_text", "_at")
    names = ["_doc", "pos", "lo", "hi", "anchor", "block", "blocks", "n"]
    schema = T.StructType([rows.schema["_doc"]])
    for name in names[1:]:
        schema = schema.add(name, "long")
    schema = schema.add("bytes", "binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, at = batch.column(1)[i].as_py().encode(), batch.column(2)[i].as_py()
                docs = batch.column(0).take(pa.array([i] * len(at)))
                columns = [pa.array([a[k] for a in at], pa.int64()) for k in names[1:]]
                parts = [data[a["pos"] + a["lo"]:a["pos"] + a["hi"] + length] for a in at]
                yield pa.RecordBatch.from_arrays([docs, *columns, pa.array(parts, pa.binary())],
                                                 names=[*names, "bytes"])

    # Many small batches: a text of any size gives as many rows as it has anchors at most.
    return joined.mapInArrow(cut, schema)


def _sorted_windows(dealt: DataFrame, length: int) -> DataFrame:
    """Per context row: (_doc, from, to) of repeated windows; classes of split anchors besides."""
    schema = T.StructType([dealt.schema["_doc"]]).add("first", "long").add("last", "long") \
        .add("key", "long").add("key2", "long").add("n", "long")
    names = ["_doc", "first", "last", "key", "key2", "n"]

    def solve(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        pos, lo, hi, anchor, block, blocks, n = (
            column[k].to_numpy() for k in ("pos", "lo", "hi", "anchor", "block", "blocks", "n"))
        parts = column["bytes"].to_pylist()
        text = Hashed(np.frombuffer(b"".join(parts), np.uint8))
        base = np.r_[0, np.cumsum([len(p) for p in parts])[:-1]]
        count = hi - lo + 1
        row = np.repeat(np.arange(len(parts)), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        offset, starts = lo[row] + step, base[row] + step
        # A segment is an anchor's block at one offset.
        group = np.unique(np.stack((anchor, block)), axis=1, return_inverse=True)[1].reshape(-1)[row]
        by = np.lexsort((offset, group))
        row, offset, starts, group = row[by], offset[by], starts[by], group[by]
        segment = group * (2 * length + 1) + offset + length
        order = sort_suffixes(text, starts, segment, length)
        row, offset, starts, segment = row[order], offset[order], starts[order], segment[order]
        same = equal_neighbours(text, starts, length) & (segment[1:] == segment[:-1])
        fresh = np.r_[True, ~same]
        label = np.cumsum(fresh) - 1
        members = np.bincount(label, weights=n[row]).astype(np.int64)[label]
        first = pos[row] + offset
        out = []
        hit = np.flatnonzero(members > 1)
        if len(hit):
            hit = hit[np.lexsort((first[hit], row[hit]))]
            brk = np.flatnonzero(np.r_[True, (row[hit][1:] != row[hit][:-1]) | (np.diff(first[hit]) != 1)])
            end = np.r_[brk[1:] - 1, len(hit) - 1]
            zero = np.zeros(len(brk), np.int64)
            out.append((row[hit][brk], first[hit][brk], first[hit][end], zero, zero, zero))
        # Classes of split anchors meet the other blocks' by hash; one row per class.
        split = np.flatnonzero(fresh & (blocks[row] > 1))
        if len(split):
            key = text.hash(starts[split], length).view(np.int64)
            half = text.hash(starts[split], length // 2).view(np.int64) ^ anchor[row[split]]
            out.append((row[split], first[split], first[split], key, half, members[split]))
        if not out:
            return None
        row, first, last, key, key2, m = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays(
            [column["_doc"].take(pa.array(row)), *(pa.array(c) for c in (first, last, key, key2, m))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def joined() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * BLOCK:
                table = joined()
                key = table.column(table.schema.names.index("anchor")).to_numpy()
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
                held[:] = [table.slice(cut)]
                if cut and (found := solve(table.slice(0, cut))) is not None:
                    yield found
        if held and (found := solve(joined())) is not None:
            yield found

    return dealt.mapInArrow(run, schema)


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = ANCHOR, block: int = BLOCK) -> DataFrame:
    """(_doc, first, last): starts of windows that occur elsewhere too, as runs, for (_doc, _text)."""
    counted = _find(rows, True, length, gram).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    # Written, so that the join below has plain shuffles on both sides and can split a hot anchor.
    twice = written(counted.filter("n > 1").select("anchor"), "twice")
    found = written(_find(rows, False, length, gram).join(twice, "anchor"), "anchors")
    kinds = found.groupBy("anchor", "around", "lo", "hi").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("_doc", "pos")).alias("rep"))
    kinds = written(kinds.select("anchor", "around", "lo", "hi", "n", "rep._doc", "rep.pos"), "kinds")

    copies = kinds.filter("n > 1").select("anchor", "around", "lo", "hi")
    copied = found.join(copies, ["anchor", "around", "lo", "hi"], "left_semi").select(
        "_doc", (F.col("pos") + F.col("lo")).alias("first"), (F.col("pos") + F.col("hi")).alias("last"))

    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    blocks = F.ceil(F.col("m") / block)
    unsure = kinds.join(mixed, "anchor").withColumn("blocks", blocks)
    unsure = unsure.withColumn("block", F.pmod(F.xxhash64("around", "lo", "hi"), "blocks"))
    around = _surroundings(rows, unsure, length)
    dealt = around.repartition("anchor", "block").sortWithinPartitions("anchor", "block")
    solved = written(_sorted_windows(dealt, length), "sorted-windows")
    sure = solved.filter("n = 0").select("_doc", "first", "last")
    classes = solved.filter("n > 0")
    met = classes.groupBy("key", "key2").agg(F.sum("n").alias("all")).filter("all > 1")
    merged = classes.join(met, ["key", "key2"], "left_semi").select("_doc", "first", "last")
    return written(copied.union(sure).union(merged), "repeats")


def remove_repeats(df: DataFrame, keep: dict[str, Column], *, id: str = "doc_id", text: str = "text",
                   length: int = LENGTH, with_text: bool = False, block: int = BLOCK) -> DataFrame:
    """``keep`` plus ``n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept_text``, binary).

    A byte goes if any string of ``length`` bytes around it also starts
    elsewhere, in this text or another row's.  A NULL text is empty; texts
    shorter than ``length`` stay; rows that repeat id and text count as
    occurrences of each other; an empty table gives an empty result.
    """
    rows = df.select(*[c.alias(k) for k, c in keep.items()], df[id].alias("_id"), whole(df[text]).alias("_text"))
    rows = rows.withColumn("_doc", F.struct("_id", F.xxhash64("_text").alias("mark"))).drop("_id")
    spans = repeated_spans(rows.select("_doc", "_text"), length, ANCHOR, block)
    by_doc = spans.groupBy("_doc").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("_spans"))
    joined = rows.join(by_doc, "_doc", "left").select(*keep, "_text", "_spans")
    added = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"
    schema = joined.drop("_text", "_spans").schema
    for field in T.StructType.fromDDL(added):
        schema = schema.add(field)
    names = schema.fieldNames()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, spans in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
                data, kept, at, removed, n = t.as_py().encode(), [], 0, 0, 0
                end = -1
                for s in spans.as_py() or ():
                    begin, stop = s["first"], s["last"] + length
                    if begin > end:  # touching runs are one
                        n += 1
                        kept.append(data[at:begin])
                    begin = max(begin, end)
                    removed += max(stop - begin, 0)
                    at = end = max(end, stop)
                kept.append(data[at:])
                rest = b"".join(kept)
                out.append((len(data), removed, n, hashlib.sha256(rest).hexdigest(), rest if with_text else None))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (
                pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=names)

    found = joined.mapInArrow(cut, schema)
    return found if with_text else found.drop("kept_text")
