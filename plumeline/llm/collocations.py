"""Collocations: phrases counted by an FM-index per shard, summed and scored.

Documents become shards of about `SHARD_WORDS` words of one language.  A
phrase can reach the least count only if each of its words, and each pair of
neighbours in it, does, so lengths are worked on in turn:

1. Shards count their words; the sums over all shards keep the frequent ones.
2. A shard indexes its frequent words twice: the word before each suffix in
   suffix order, and the word after each prefix in reversed order.  An interval
   of the one is kept in step with an interval of the other, so a phrase grows
   to either side.  Pairs grow to the right, and are summed over the shards.
3. Frequent pairs grow to the left to three words and again to the right to
   four, wherever the new pair is frequent too, and are summed likewise.

Suffixes are ordered by as many words as the longest phrase has, which is all
that intervals of such phrases see.  A word's count travels with the number of
its shard and its place in the shard's own list, which names it on the way back.
Longer phrases are far more, and most of them too rare: a shard deals them to
blocks by a hash of their names and sends one packed row to a block, which adds
up exact counts and answers with marks in the order of the shard's row.  A shard
lists a phrase once, so no phrase takes more of its block than there are shards.
Parts of a phrase are phrases themselves, found by the names they carry, and
one-word extensions decide whether a phrase only lives inside a longer one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .text import whole, written

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
SHARD_WORDS = 1 << 21
BLOCK_WORDS = 1 << 21
SCALE = 2_000_000
INSIDE_PERCENT = 80
UNKNOWN_LANG = "und"
_SALTS = 256
_PLACES = 31  # bits of a place in a shard's list, or of a phrase's place in its block
_SHARDS = 12  # bits of a shard's number in its task
# Characters that end a piece of text.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_BREAK = b"\xff"  # in no UTF-8 text
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE = bytes.maketrans(_ENDS, _BREAK * len(_ENDS))


class _Vocabulary(dict):
    """Words of a shard in the order they came; 0 is the break between pieces."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Buffer:
    """Words of one language on their way to a shard."""

    def __init__(self) -> None:
        self.words, self.parts, self.size = _Vocabulary({_BREAK: 0}), [], 0

    def add(self, text: bytes) -> None:
        tokens = text.lower().translate(_TABLE).replace(_BREAK, b" " + _BREAK + b" ").split()
        self.parts.append(np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(tokens) + 1


def shards(df: DataFrame, lang: Column, text: Column, shard_words: int) -> DataFrame:
    """(shard, lang, words, counts, size, ids): each document's words in one shard, in order."""
    rows = df.select(F.coalesce(lang.cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                     whole(text).cast("binary").alias("text"))
    schema = "shard long, lang string, words array<binary>, counts array<int>, size int, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers: dict[str, _Buffer] = {}
        made = 0

        def full(lang: str) -> pa.RecordBatch:
            nonlocal made
            if made >> _SHARDS:
                raise ValueError("a task has too many shards; read it in smaller partitions")
            shard, buffer = TaskContext.get().partitionId() << _SHARDS | made, buffers.pop(lang)
            made += 1
            ids = np.concatenate(buffer.parts)
            counts = np.bincount(ids, minlength=len(buffer.words)).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([lang]), pa.array([list(buffer.words)[1:]], pa.list_(pa.binary())),
                 pa.array([counts[1:]], pa.list_(pa.int32())), pa.array([len(ids)], pa.int32()),
                 pa.array([_packed(ids)], pa.binary())], names=["shard", "lang", "words", "counts", "size", "ids"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                buffer = buffers.setdefault(lang, _Buffer())
                buffer.add(text.as_py())
                if buffer.size >= shard_words:
                    yield full(lang)
                elif sum(b.size for b in buffers.values()) >= 2 * shard_words:  # many languages
                    yield full(max(buffers, key=lambda k: buffers[k].size))
        for lang in list(buffers):
            yield full(lang)

    return rows.mapInArrow(run, schema)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in order of the ``depth`` or more words that begin there."""
    key, top, width = text.astype(np.int64), int(text.max(initial=0)) + 1, 1
    while width < depth:
        if top * top >= 1 << 62:
            names, key = np.unique(key, return_inverse=True)
            top = len(names)
        key = key * top + np.r_[key[width:], np.zeros(min(width, len(key)), np.int64)][:len(key)]
        top, width = top * top, 2 * width
    return np.argsort(key, kind="stable")


class _Way:
    """One direction of the index: the word before each suffix, in suffix order."""

    def __init__(self, text: np.ndarray, begins: np.ndarray) -> None:
        self.begins = begins
        self.before = text[suffix_order(text, MAX_WORDS) - 1]  # text begins and ends with a break

    def grow(self, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, word, count, number of smaller words) of each one-word extension."""
        which = np.repeat(np.arange(len(low), dtype=np.int32), count)
        at = np.arange(len(which), dtype=np.int32)
        at += np.repeat((low - np.cumsum(count) + count).astype(np.int32), count)
        keys = which.astype(np.int64)
        del which
        keys *= len(self.begins)
        keys += self.before[at]
        del at
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        n = np.diff(np.r_[first, len(keys)])
        parent, word = np.divmod(keys[first], len(self.begins))
        smaller = first - first[np.searchsorted(parent, parent)]
        kept = np.flatnonzero(word)
        return parent[kept], word[kept], n[kept], smaller[kept]

    def rank(self, word: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Where the intervals of these words before what the intervals at ``low`` begin with start."""
        order = np.argsort(self.before, kind="stable")
        places = self.before[order].astype(np.int64)
        places *= len(order)
        places += order
        return np.searchsorted(places, word * len(order) + low)  # counts all smaller words too


def reduced(ids: np.ndarray, live: np.ndarray) -> np.ndarray:
    """A shard's text in its frequent words (places in ``live``), one break between pieces."""
    numbers = np.zeros(int(ids.max(initial=0)) + 1, np.int32)
    numbers[live + 1] = np.arange(1, len(live) + 1)
    text = np.r_[np.int32(0), numbers[ids], np.int32(0)]
    return text[(text > 0) | np.r_[True, text[:-1] > 0]]


class Index:
    """Bidirectional index of a reduced text of ``n_words`` different words."""

    def __init__(self, text: np.ndarray, n_words: int) -> None:
        self.text, self.size = text, n_words + 1
        self.begins = np.searchsorted(np.sort(text), np.arange(n_words + 1))
        self.low = self.begins[1:]
        self.count = np.diff(np.r_[self.begins, len(text)])[1:]

    @cached_property
    def forward(self) -> _Way:
        return _Way(self.text, self.begins)

    @cached_property
    def back(self) -> _Way:
        return _Way(self.text[::-1], self.begins)

    def pairs(self) -> tuple[np.ndarray, ...]:
        """(first word, second word, low, count), sorted by the words."""
        parent, word, count, smaller = self.back.grow(self.low, self.count)
        return parent + 1, word, self.low[parent] + smaller, count


def _places(listed: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of a shard's frequent words and their names, ascending by name."""
    place, name = listed["place"].to_numpy(), listed["name"].to_numpy()
    order = np.argsort(name)
    return place[order].astype(np.int64), name[order]


def _packed(values: np.ndarray) -> bytes:
    """Values compressed with their lowest bytes first, then the next: the higher ones hardly vary."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(packed, decompressed_size=size * width, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(width, size).T.copy().view(kind).reshape(size)


_REDUCED = "shard long, size int, ids binary, n_words int, names binary"
_DEALT = "block int, shard long, size int, columns array<binary>"
_PAIRS = "shard long, block int, size int, marks binary, names binary, name long, a long, b long, total long"
_LONGER = "a long, b long, c long, total long"


def _by_block(keys: list[np.ndarray], blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of a shard's phrases by block and first key, and where each block begins in it."""
    mixed = np.zeros(len(keys[0]), np.uint64)
    for key in keys:
        mixed = (mixed ^ key.astype(np.uint64)) * _MIX
        mixed ^= mixed >> np.uint64(32)
    block = (mixed * _MIX >> np.uint64(33)) % np.uint64(blocks)
    order = np.lexsort((keys[0], block))
    return order, np.searchsorted(block[order], np.arange(blocks + 1, dtype=np.uint64))


def _dealt(shard: int, keys: list[np.ndarray], n: np.ndarray, blocks: int) -> pa.RecordBatch:
    """A shard's phrases and their counts, one packed row for each block that gets any."""
    order, begins = _by_block(keys, blocks)
    filled = np.flatnonzero(np.diff(begins))
    columns = [c[order] for c in (*keys, n)]
    packed = []
    for begin, end in zip(begins[filled].tolist(), begins[filled + 1].tolist()):
        first, *others = (c[begin:end] for c in columns)
        packed.append([_packed(c.astype(np.int64)) for c in (np.diff(first, prepend=0), *others)])
    return pa.RecordBatch.from_arrays(
        [pa.array(filled, pa.int32()), pa.array(np.full(len(filled), shard), pa.int64()),
         pa.array(np.diff(begins)[filled], pa.int32()), pa.array(packed, pa.list_(pa.binary()))],
        names=["block", "shard", "size", "columns"])


def _summed(dealt: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(keys, total, and for each packed phrase which of these it is) of a block, ascending by keys."""
    rows = zip(dealt["columns"].to_pylist(), dealt["size"].to_pylist())
    columns = [np.concatenate(c) for c in zip(*(
        [np.cumsum(c) if i == 0 else c for i, c in enumerate(_unpacked(p, size, np.int64) for p in packed)]
        for packed, size in rows))]
    order = np.lexsort(columns[-2::-1])
    *keys, n = (c[order] for c in columns)
    new = np.zeros(len(n), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    which = np.empty(len(n), np.int32)
    which[order] = np.cumsum(new) - 1
    return [key[first] for key in keys], np.add.reduceat(n, first), which


def _reduced_shard(shard: pa.Table, listed: pa.Table) -> pa.Table:
    """The shard with its frequent words only; none if it has none."""
    names = ["shard", "size", "ids", "n_words", "names"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
    if not shard.num_rows or not listed.num_rows:
        return pa.table([pa.array([], k) for k in kinds], names=names)
    live, name = _places(listed)
    text = reduced(_unpacked(shard["ids"][0].as_py(), shard["size"][0].as_py(), np.int32), live)
    row = [shard["shard"][0].as_py(), len(text), _packed(text), len(live), _packed(name)]
    return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _loaded(row: dict) -> tuple[Index, np.ndarray]:
    """The index of a reduced shard and the names of its words."""
    return (Index(_unpacked(row["ids"], row["size"], np.int32), row["n_words"]),
            _unpacked(row["names"], row["n_words"], np.int64))


def _pair_counts(blocks: int):
    """Shards to their pairs, named by the words and dealt to blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                index, word = _loaded(row)
                first, second, _, count = index.pairs()
                del index
                if len(first):
                    yield _dealt(row["shard"], [word[first - 1], word[second - 1]], count, blocks)

    return run


def _frequent_pairs(min_count: int):
    """A block to its frequent pairs, and to each shard's marks at them with their names."""
    def run(dealt: pa.Table) -> pa.Table:
        block = dealt["block"][0].as_py()
        (a, b), total, which = _summed(dealt)
        frequent = total >= min_count
        name = (block << _PLACES) + np.cumsum(frequent) - 1
        marks, names, sizes, ends = [], [], [], np.cumsum(dealt["size"].to_numpy())
        for part in np.split(which, ends[:-1]):
            mark = frequent[part]
            marks.append(_packed(np.packbits(mark)))
            names.append(_packed(np.diff(name[part[mark]], prepend=0)))
            sizes.append(int(mark.sum()))
        told = pa.table({"shard": dealt["shard"], "block": dealt["block"], "size": pa.array(sizes, pa.int32()),
                         "marks": pa.array(marks, pa.binary()), "names": pa.array(names, pa.binary())})
        pairs = pa.table({"name": name[frequent], "a": a[frequent], "b": b[frequent], "total": total[frequent]})
        return pa.concat_tables([told.filter(pa.array(np.array(sizes) > 0)), pairs], promote_options="default").select(
            [c.split()[0] for c in _PAIRS.split(", ")])

    return run


def _told(keys: list[np.ndarray], listed: pa.Table, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a shard's frequent pairs, ascending, and their names, from the marks of the blocks."""
    order, begins = _by_block(keys, blocks)
    places, names = [], []
    for row in listed.to_pylist():
        part = order[begins[row["block"]]:begins[row["block"] + 1]]
        marks = np.unpackbits(_unpacked(row["marks"], -(-len(part) // 8), np.uint8), count=len(part))
        places.append(part[marks.astype(bool)])
        names.append(np.cumsum(_unpacked(row["names"], row["size"], np.int64)))
    place, name = np.concatenate(places), np.concatenate(names)
    order = np.argsort(place)
    return place[order], name[order]


def _longer_counts(blocks: int):
    """Phrases of three words and four, named by their neighbouring pairs (the last is -1 for three)."""
    def run(shard: pa.Table, listed: pa.Table) -> pa.Table:
        if not shard.num_rows or not listed.num_rows:
            return pa.Table.from_batches([_dealt(0, [np.empty(0, np.int64)], np.empty(0, np.int64), 1)])
        index, word = _loaded(shard.to_pylist()[0])
        first, second, low, count = index.pairs()
        live, name = _told([word[first - 1], word[second - 1]], listed, blocks)
        first, second, low, count = (c[live] for c in (first, second, low, count))
        back = index.back.rank(second, index.low[first - 1])
        keys = first * index.size + second

        def pair(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Number of the pair of words, and whether it is frequent."""
            at = np.minimum(np.searchsorted(keys, a * index.size + b), len(keys) - 1)
            return at, keys[at] == a * index.size + b

        # To the left; the interval in the reversed order shrinks by the smaller words.
        parent, word, n, smaller = index.forward.grow(low, count)
        before, fits = pair(word, first[parent])
        parent, before, n, back = (x[fits] for x in (parent, before, n, back[parent] + smaller))
        three = name[before], name[parent], np.full(len(n), -1), n
        # To the right from there.
        triple, word, n, _ = index.back.grow(back, n)
        after, fits = pair(second[parent[triple]], word)
        triple, after, n = triple[fits], after[fits], n[fits]
        four = name[before[triple]], name[parent[triple]], name[after], n
        *keys, n = (np.concatenate(c) for c in zip(three, four))
        return pa.Table.from_batches([_dealt(shard["shard"][0].as_py(), keys, n, 2 * blocks)])

    return run


def _frequent_longer(min_count: int):
    """A block to its frequent phrases of three words (c is NULL) and four."""
    def run(dealt: pa.Table) -> pa.Table:
        keys, total, _ = _summed(dealt)
        a, b, c, total = (x[total >= min_count] for x in (*keys, total))
        return pa.table({"a": a, "b": b, "c": pa.array(c, pa.int64(), mask=c < 0), "total": total})

    return run


def _frequent(rows: DataFrame, key: list[str], min_count: int) -> DataFrame:
    """Rows of frequent keys with their total and name, the smallest place of the key."""
    group = Window.partitionBy(*key)
    return rows.withColumns({"total": F.sum("n").over(group), "name": F.min("at").over(group)}).filter(
        F.col("total") >= min_count)


def _listed(rows: DataFrame) -> DataFrame:
    """Places and names of frequent phrases, on their way back to the shards."""
    place = F.col("at").bitwiseAND(F.lit((1 << _PLACES) - 1))
    return rows.select(F.shiftright("at", _PLACES).alias("shard"), place.cast("int").alias("place"), "name")


def _joined(rows: DataFrame, head: DataFrame, head_key: dict[str, str], tail: DataFrame,
            tail_key: dict[str, str]) -> DataFrame:
    """``rows`` with the phrase and counts of parts that their first and last words make.

    heads[k - 1] counts the first k words, tails[k - 1] the last k.
    """
    left = head.select(*[F.col(v).alias(k) for k, v in head_key.items()], "lang", "phrase", "heads")
    right = tail.select(*[F.col(v).alias(k) for k, v in tail_key.items()], "last", "tails")
    joined = rows.join(left, list(head_key)).join(right, list(tail_key))
    words = F.size("heads")
    cuts = F.transform(F.sequence(F.lit(1), words), lambda k: F.struct(
        k.alias("k"), F.get("heads", k - 1).alias("l"), F.get("tails", words - k).alias("r")))
    return joined.withColumn("cuts", cuts).select(*rows.columns, "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last",
                         F.concat("heads", F.array("total")).alias("heads"),
                         F.concat("tails", F.array("total")).alias("tails"), "cuts")


def _longest(rows: DataFrame, parts: tuple[dict[str, str], ...]) -> DataFrame:
    """The largest count among one-word extensions, by the key of the part they extend."""
    every = None
    for part in parts:
        one = rows.select(*[F.col(v).alias(k) for k, v in part.items()], "total")
        every = one if every is None else every.union(one)
    return every.groupBy(*parts[0]).agg(F.max("total").alias("extended"))


def phrases(df: DataFrame, *, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT,
            shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(phrases of two to four words, words per language).

    Phrases: ``lang, phrase, a`` (its count), ``cuts`` (k, l, r: counts of the
    first k words and of the rest) and ``extended``, the largest count of a
    frequent phrase of at most four words that is one word longer.
    """
    made = written(shards(df, df[lang], df[text], shard_words), "shards")
    sizes = made.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n"))
    sizes = sizes.groupBy("lang").agg(F.sum("n").alias("n"))
    vocabulary = made.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "lang", F.col("col.words").alias("word"), F.col("col.counts").alias("n"),
        (F.shiftleft("shard", _PLACES) + F.col("pos")).alias("at"))
    words = written(_frequent(vocabulary, ["lang", "word"], min_count), "words")
    texts = made.select("shard", "size", "ids").groupBy("shard").cogroup(
        _listed(words).groupBy("shard")).applyInArrow(_reduced_shard, _REDUCED)
    texts = written(texts, "reduced")
    blocks = 1 + (texts.agg(F.sum("size")).first()[0] or 0) // BLOCK_WORDS
    pairs = texts.mapInArrow(_pair_counts(blocks), _DEALT).groupBy("block").applyInArrow(_frequent_pairs(min_count), _PAIRS)
    pairs = written(pairs, "pairs")
    told = pairs.filter("shard is not null").select("shard", "block", "size", "marks", "names")
    longer = texts.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(_longer_counts(blocks), _DEALT)
    longer = written(longer.groupBy("block").applyInArrow(_frequent_longer(min_count), _LONGER), "longer")

    total = F.array("total")
    spelled = F.col("word").cast("string")
    one = words.filter("at = name").select("name", "lang", spelled.alias("phrase"), spelled.alias("last"),
                                           total.alias("heads"), total.alias("tails"))
    two = pairs.filter("shard is null").select("name", "a", "b", "total")
    two = written(_joined(two, one, {"a": "name"}, one, {"b": "name"}), "two")
    three = longer.filter("c is null").select("a", "b", "total")
    three = written(_joined(three, two, {"a": "name"}, two, {"b": "name"}), "three")
    four = longer.filter("c is not null")
    four = _joined(four, three, {"a": "a", "b": "b"}, three, {"b": "a", "c": "b"})

    over_two = _longest(three, ({"name": "a"}, {"name": "b"}))
    over_three = _longest(longer.filter("c is not null"), ({"a": "a", "b": "b"}, {"a": "b", "b": "c"}))
    columns = ["lang", "phrase", F.col("total").alias("a"), "cuts", "extended"]
    found = two.join(over_two, "name", "left").select(*columns).union(
        three.join(over_three, ["a", "b"], "left").select(*columns)).union(
        four.withColumn("extended", F.lit(None).cast("long")).select(*columns))
    return found, sizes


def collocations(df: DataFrame, *, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT,
                 top: int = TOP, inside_percent: int = INSIDE_PERCENT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase counts ``a`` times; cut in two it scores ``SCALE * a / (l + r)``,
    rounded down, at its weakest cut.  It is left out if a frequent phrase around
    it has ``inside_percent`` of its count; one-word extensions tell, as a
    longer phrase never counts more than they do.  Ranks go by score, count and
    bytes of the phrase.  A NULL language is `UNKNOWN_LANG`, a NULL text is
    empty, repeated rows count again, an empty table gives no phrases, and other
    columns are not read.  A shard and its index take some eighty bytes a word;
    a text is never split between shards.
    """
    found, sizes = phrases(df, lang=lang, text=text, min_count=min_count, shard_words=shard_words)
    exact = lambda c: c.cast("decimal(20,0)")
    found = found.filter(F.col("extended").isNull() | (
        exact(F.col("extended")) * 100 < exact(F.col("a")) * inside_percent))
    score = lambda c: F.call_function(
        "div", exact(F.col("a")) * F.lit(SCALE).cast("decimal(10,0)"), exact(c["l"]) + exact(c["r"]))
    cut = F.array_min(F.transform("cuts", lambda c: F.struct(
        score(c).alias("score"), c["k"].alias("k"), c["l"].alias("l"), c["r"].alias("r"))))
    scored = found.select("lang", "phrase", "a", cut.alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Two steps, so that no language is ranked whole in one task.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    part = Window.partitionBy("lang", salt).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return best.filter(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
