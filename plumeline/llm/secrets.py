"""Secret scan: fixed patterns plus windows of high entropy, with an allow-list.

Patterns give the base spans.  The entropy scan takes maximal runs of one
character class, slides a window along each while keeping symbol counts up to
date, and reports where the window's Shannon entropy reaches the class limit.
All counts are integers (entropy terms in millionths), so results are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from .text import whole

# The base patterns.
ASSIGN = (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
_HEX_RUN = r"(?<![0-9a-f])[0-9a-f]{32,}+"
_ACCESS_RUN = r"AKIA[A-Z0-9]{12,}+"


@dataclass(frozen=True)
class EntropyClass:
    """A character class whose runs are scanned, and the entropy that is suspicious."""

    kind: str
    alphabet: str
    bits: float
    window: int = 20
    needs: tuple[str, ...] = ()


_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    EntropyClass("entropy_hex", _DIGITS + "abcdefABCDEF", 3.0, needs=("[0-9]", "[a-fA-F]")),
    EntropyClass("entropy_base64", _UPPER + _LOWER + _DIGITS + "+/_=-", 3.9,
                 needs=("[0-9]", "[A-Z]", "[a-z]")),
    # One case and digits, past what hex holds; fewer symbols give lower entropies.
    EntropyClass("entropy_lower", _LOWER + _DIGITS, 3.6, needs=("[0-9]", "[g-z]")),
    EntropyClass("entropy_upper", _UPPER + _DIGITS, 3.5, needs=("[0-9]", "[G-Z]")),
)
KINDS = ("assign", "access", "hex", *[c.kind for c in CLASSES])
_UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
# Words and numbers joined by - or _; possessive, so that a run of any length is read in one pass.
_WORD = r"(?:[A-Z]?[a-z]{2,}+[0-9]{0,4}+|[a-z]|[0-9]{1,8}+)"
_SEGMENT = rf"(?:{_UUID}|{_WORD}(?:[_-]++{_WORD})*+)"
# Runs that look random but are known to be harmless as a whole.
ALLOWED = (rf"^{_UUID}$",)
# Parts of a run that excuse the windows inside them: segments of a path.
ALLOWED_AROUND = (rf"(?<![^/])(?:{_SEGMENT}?+/)++(?:{_SEGMENT}(?![^/]))?+",)
# What excuses the windows that hold it, and no other.
ALLOWED_INSIDE = (
    r"(?i)example|placeholder|dummy|changeme|your[_-]",
    r"0123456789|12345678|abcdefgh|ABCDEFGH",
    r"(.)\1{7}",
)
_SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def _no_spans() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                    end.cast("int").alias("end"), F.lit(kind).alias("kind"))


def _located(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap, as (start, found), in code points.

    The pieces between matches and the matches themselves alternate, so their
    lengths add up to the starts.  The pieces are only cut where a match exists.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("found"))
    empty = F.array().cast("array<struct<start:int,found:string>>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["piece"])
        return F.struct((start + F.length(F.coalesce(part["found"], F.lit("")))).alias("at"),
                        F.concat(acc["out"], F.array(F.struct(
                            start.alias("start"), part["found"].alias("found")))).alias("out"))

    every = F.aggregate(parts, state, step, lambda acc: acc["out"])
    return F.when(F.size(found) == 0, empty).otherwise(
        F.filter(every, lambda m: m["found"].isNotNull()))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns.

    An assignment whose value is shorter than eight characters is dropped, and
    what it consumed is not searched again.  The other two patterns match whole
    runs, so their minimum length can be part of the pattern.
    """
    def spans(kind: str, pattern: str, good=lambda m: F.lit(True)) -> Column:
        hits = F.filter(_located(text, pattern), lambda m: good(m["found"]))
        return F.transform(hits, lambda m: _span(kind, m["start"], m["start"] + F.length(m["found"])))

    return F.concat(
        spans("assign", ASSIGN, lambda s: F.length(F.regexp_extract(s, ASSIGN, 2)) >= 8),
        spans("access", _ACCESS_RUN), spans("hex", _HEX_RUN))


def _terms(window: int) -> list[int]:
    """c * log2(c) in millionths, for counts up to a window."""
    return [0] + [round(c * log2(c) * 1_000_000) for c in range(1, window + 1)]


def entropy_limit(cls: EntropyClass) -> int:
    """Largest sum of terms at which a window is still suspicious."""
    return int((log2(cls.window) - cls.bits) * cls.window * 1_000_000)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _windows(run: Column, cls: EntropyClass) -> Column:
    codes = F.transform(F.split(run, "", -1), lambda c: F.call_function(
        "locate", c, F.lit(cls.alphabet)) - 1)
    return _let(codes, lambda symbols: _let(_harmless_parts(run), lambda parts: _suspicious_windows(
        symbols, F.length(run), cls, lambda begin: _excused(run, parts, begin, cls.window))))


def _harmless_parts(run: Column) -> Column:
    """(start, found) of the parts of a run that excuse the windows inside them."""
    return F.concat(*[_located(run, pattern) for pattern in ALLOWED_AROUND])


def _excused(run: Column, parts: Column, begin: Column, window: int) -> Column:
    """Does the allow-list excuse the window that starts at ``begin``?"""
    within = F.exists(parts, lambda p: (p["start"] <= begin) & (
        begin + window <= p["start"] + F.length(p["found"])))
    own = F.substring(run, begin + 1, F.lit(window))
    for harmless in ALLOWED_INSIDE:
        within = within | own.rlike(harmless)
    return within


def _suspicious_windows(symbols: Column, length: Column, cls: EntropyClass,
                        excused: Callable[[Column], Column]) -> Column:
    """Merged (start, end) of the run's suspicious windows that are not ``excused``.

    One fold over the run: the entering and the leaving symbol change two
    counts, and the sum of c * log2(c) follows from those two.
    """
    terms = F.array(*[F.lit(t).cast("bigint") for t in _terms(cls.window)])
    w, limit = cls.window, entropy_limit(cls)
    pairs = "array<struct<start:int,end:int>>"
    zero = F.struct(
        F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
        F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("i"),
        F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast(pairs).alias("done"))

    def slide(acc: Column, i: Column) -> Column:
        entering = F.get(symbols, i)
        leaving = F.when(i >= w, F.get(symbols, F.greatest(i - w, F.lit(0)))).otherwise(F.lit(-1))
        grown = F.transform(acc["counts"], lambda c, k: c + (k == entering).cast("int"))
        total = acc["sum"] + F.get(terms, F.get(grown, entering)) - F.get(
            terms, F.get(grown, entering) - 1)
        gone = F.get(grown, F.greatest(leaving, F.lit(0)))
        counts = F.transform(grown, lambda c, k: c - (k == leaving).cast("int"))
        total = F.when(leaving < 0, total).otherwise(
            total - F.get(terms, gone) + F.get(terms, F.greatest(gone - 1, F.lit(0))))
        begin = i - (w - 1)
        hit = (i >= w - 1) & (total <= limit) & ~excused(begin)
        joins = (acc["end"] >= 0) & (begin <= acc["end"])
        closed = F.when(hit & ~joins & (acc["end"] >= 0), F.concat(acc["done"], F.array(F.struct(
            acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["done"])
        return F.struct(
            counts.alias("counts"), total.alias("sum"), (i + 1).alias("i"),
            F.when(hit & ~joins, begin).otherwise(acc["start"]).alias("start"),
            F.when(hit, i + 1).otherwise(acc["end"]).alias("end"), closed.alias("done"))

    def finish(acc: Column) -> Column:
        return F.when(acc["end"] < 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(
            acc["start"].alias("start"), acc["end"].alias("end")))))

    return F.aggregate(F.sequence(F.lit(0), length - 1), zero, slide, finish)


def entropy_spans(text: Column, classes: tuple[EntropyClass, ...] = CLASSES,
                  allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Spans of suspicious windows in runs of each class; the allow-list excuses windows, not their runs."""
    def of(cls: EntropyClass) -> Column:
        inside = "[" + cls.alphabet.replace("-", r"\-") + "]"
        runs = _located(text, f"(?<!{inside}){inside}{{{cls.window},}}+")

        def suspicious(m: Column) -> Column:
            test = F.lit(True)
            for needed in cls.needs:
                test = test & m["found"].rlike(needed)
            for harmless in allowed:
                test = test & ~m["found"].rlike(harmless)
            return test

        def placed(m: Column) -> Column:
            return F.transform(_windows(m["found"], cls), lambda p: _span(
                cls.kind, m["start"] + p["start"], m["start"] + p["end"]))

        return F.flatten(F.transform(F.filter(runs, suspicious), placed))

    return F.concat(_no_spans(), *[of(cls) for cls in classes])


def find_secrets(df: DataFrame, keep: dict[str, Column], *, text: str = "text") -> DataFrame:
    """``keep`` plus ``base`` and ``spans``: arrays of (start, rank, end, kind), sorted.

    Positions are code points, ends exclusive; ``spans`` holds the base spans
    and those of the entropy scan.  A NULL or empty text has none; repeated
    rows are reported each; every row is kept.
    """
    rows = df.select(*[c.alias(k) for k, c in keep.items()], whole(text).alias("_text"))
    rows = rows.withColumn("_base", F.array_sort(base_spans(F.col("_text"))))
    rows = rows.withColumn("_more", entropy_spans(F.col("_text")))
    return rows.select(*keep, "_text", F.col("_base").alias("base"),
                       F.array_sort(F.concat("_base", "_more")).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, *, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``df`` with every span in ``text`` replaced by ``mask``; a NULL text stays NULL.

    Overlapping spans become one mask; rows and other columns are untouched.
    """
    names = df.columns
    keep = {f"_c{i}": df[c] for i, c in enumerate(names)}
    found = find_secrets(df, keep, text=text)
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(F.col("_text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["end"] <= acc["at"], acc).when(s["start"] < acc["at"], F.struct(
            acc["out"].alias("out"), s["end"].alias("at"))).otherwise(F.struct(
                F.concat(acc["out"], between, F.lit(mask)).alias("out"), s["end"].alias("at")))

    masked = F.aggregate("spans", empty, step, lambda acc: F.concat(acc["out"], F.substring(
        F.col("_text"), acc["at"] + 1, F.length("_text"))))
    return found.select(*[
        (F.when(F.size("spans") > 0, masked).otherwise(F.col(f"_c{i}")) if c == text
         else F.col(f"_c{i}")).alias(c) for i, c in enumerate(names)])
