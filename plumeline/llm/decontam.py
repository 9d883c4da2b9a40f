"""Benchmark decontamination: windows of test-set words found in training text.

The distinct windows of the benchmark form a hash set that travels with the
plan.  A document is scanned once: words that occur in the set's anchors (a
long word of each window) propose window starts, those are hashed whole and
looked up, and hits are verified word by word.  Only hits leave the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import LOWER, UPPER, lower_ascii, whole

WINDOW = 10
# A larger set of windows is joined by a shuffle instead.
MAX_SET = 50_000
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_HITS = "array<struct<start:int,n:int>>"


def raw_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, case kept."""
    return F.filter(F.split(text, _GAPS, -1), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, *, item_id: str = "item_id", text: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``window_text, n, anchor, items`` (item ids as strings).

    An item shorter than a window is one window of its own length.  The anchor
    is the longest word of the window, then the one that fewest windows have:
    long words are rare in a corpus, whatever its language.
    """
    words = raw_words(lower_ascii(whole(text)))
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                             words.alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    cut = items.select("item", "w", n.alias("n"),
                       F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("at"))
    cut = cut.select("item", "n", F.slice("w", F.col("at"), F.col("n")).alias("words"))
    grouped = cut.groupBy("words", "n").agg(F.collect_set("item").alias("items"))
    grouped = grouped.select(F.array_join("words", " ").alias("window_text"), "n", "words", "items")
    spread = grouped.select("window_text", F.explode(F.array_distinct("words")).alias("word"))
    common = spread.groupBy("word").agg(F.count(F.lit(1)).alias("seen"))
    anchors = spread.join(common, "word").groupBy("window_text").agg(
        F.min_by("word", F.struct(-F.length("word"), "seen", "word")).alias("anchor"))
    return grouped.drop("words").join(anchors, "window_text")


def window_text(words: Column, start: Column, n: Column) -> Column:
    return lower_ascii(F.array_join(F.slice(words, start + 1, n), " "))


def _hash_of_split(column: str) -> Column:
    """The hash that a document's window gets, from the window's own text."""
    return F.expr(f"xxhash64(transform(split({column}, ' ', -1), w -> lower(w)))")


def _proposed(windows: list) -> Column:
    """Hits of the set in ``_words``: array of (start, n), by anchor, hash and then text.

    Anchors and hashes fold the case of all letters, which can only add
    proposals; the last filter compares the exact text of each.  Written as
    SQL text because a set of thousands of literals is parsed in one go.
    """
    by_length: dict[int, list] = {}
    for row in windows:
        by_length.setdefault(row.n, []).append(row)

    def hits(n: int, rows: list) -> str:
        anchors, hashes = ({str(r[k]) for r in rows} for k in ("anchor_hash", "window_hash"))
        # Words hold no quote and no backslash: those separate words.
        texts = ", ".join(f"'{r.window_text}'" for r in rows)
        marked = (f"transform(_words, (w, i) -> if(xxhash64(lower(w)) IN ({', '.join(anchors)}), i, -1))")
        near = (f"transform(filter({marked}, i -> i >= 0), i -> filter(sequence(i - {n - 1}, i), "
                f"s -> s >= 0 AND s <= size(_words) - {n}))")
        window = f"transform(slice(_words, s + 1, {n}), w -> lower(w))"
        likely = f"filter(array_distinct(flatten({near})), s -> xxhash64({window}) IN ({', '.join(hashes)}))"
        text = f"translate(array_join(slice(_words, s + 1, {n}), ' '), '{UPPER}', '{LOWER}')"
        return (f"transform(filter({likely}, s -> {text} IN ({texts})), "
                f"s -> named_struct('start', s, 'n', {n}))")

    each = [F.expr(hits(n, rows)) for n, rows in sorted(by_length.items())]
    return F.concat(F.array().cast(_HITS), *each)


def _every_window(lengths: list[int], words: Column) -> Column:
    def starts(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda s: F.struct(
            s.alias("start"), F.lit(n).alias("n")))
        return F.when(F.size(words) >= n, each).otherwise(F.array().cast(_HITS))

    return F.concat(F.array().cast(_HITS), *[starts(n) for n in lengths])


def _with_hits(df: DataFrame, windows: DataFrame, small: bool) -> DataFrame:
    """Adds ``_at``: verified hits if the set is small, else all windows to be joined."""
    words = F.col("_words")
    if not small:  # as many lengths as a window has words, at most
        return df.withColumn("_at", _every_window(
            [r.n for r in windows.select("n").distinct().collect()], words))
    collected = windows.select(
        "window_text", "n", F.xxhash64(F.lower("anchor")).alias("anchor_hash"),
        _hash_of_split("window_text").alias("window_hash")).collect()
    return df.withColumn("_at", _proposed(collected))


def find_hits(df: DataFrame, benchmark: DataFrame, keep: dict[str, Column], *, text: str = "text",
              item_id: str = "item_id", window: int = WINDOW, max_set: int = MAX_SET) -> DataFrame:
    """``keep`` plus ``n_words, hit_words, items`` for every row of ``df``.

    ``hit_words`` are the positions of words inside any occurrence of a window,
    ``items`` the sorted ids whose windows occur.  A NULL text has no words, a
    NULL item id counts as the empty id, an empty benchmark hits nothing, and
    repeated rows are reported each.
    """
    windows = benchmark_windows(benchmark, item_id=item_id, window=window)
    small = windows.limit(max_set + 1).count() <= max_set
    named = list(keep)
    # The row number ties the two sides of one shuffle together; it leads no further.
    rows = df.select(*[c.alias(k) for k, c in keep.items()], raw_words(whole(text)).alias("_words"),
                     F.monotonically_increasing_id().alias("_row"))
    rows = _with_hits(rows, windows, small)
    rows = rows.withColumn("_hits", F.transform("_at", lambda h: F.struct(
        h["start"].alias("start"), h["n"].alias("n"),
        window_text(F.col("_words"), h["start"], h["n"]).alias("text"))))
    rows = rows.select("_row", *named, F.size("_words").cast("bigint").alias("n_words"),
                       F.explode_outer("_hits").alias("_hit"))
    known = windows.select("window_text", F.col("items").alias("_items"))
    joined = rows.join(F.broadcast(known) if small else known,
                       F.col("_hit.text") == F.col("window_text"), "left")
    inside = F.when(F.col("_items").isNotNull(), F.sequence(
        F.col("_hit.start"), F.col("_hit.start") + F.col("_hit.n") - 1))
    grouped = joined.groupBy("_row", *named, "n_words").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(inside)))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"))
    return grouped.drop("_row")


def drop_contaminated(df: DataFrame, benchmark: DataFrame, *, text: str = "text",
                      item_id: str = "item_id", window: int = WINDOW,
                      max_set: int = MAX_SET) -> DataFrame:
    """The rows of ``df`` in which no benchmark window occurs; nulls as in `find_hits`.

    With a set that travels with the plan this needs no shuffle.
    """
    names = df.columns
    keep = {f"_c{i}": df[c] for i, c in enumerate(names)}
    windows = benchmark_windows(benchmark, item_id=item_id, window=window)
    if windows.limit(max_set + 1).count() <= max_set:
        # The row number in the filter keeps it above the split: pushed below, the words
        # would be split anew for every window that is looked at.
        rows = df.select(*[c.alias(k) for k, c in keep.items()],
                         raw_words(whole(text)).alias("_words"),
                         F.monotonically_increasing_id().alias("_row"))
        clean = _with_hits(rows, windows, True).filter((F.size("_at") == 0) & (F.col("_row") >= 0))
    else:
        clean = find_hits(df, benchmark, keep, text=text, item_id=item_id, window=window,
                          max_set=max_set).filter(F.size("hit_words") == 0)
    return clean.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
