"""Column expressions and small helpers shared by the text operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

# The six white-space characters that separate words, ASCII letters.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column | str) -> Column:
    """The text, with NULL read as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.cast("string"), F.lit(""))


def space_words(text: Column) -> Column:
    """Runs of anything but white space, as an array."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+", -1))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``.

    A local session that names no such folder gets one of its own; a cluster
    must name one, as its machines share no other.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plumeline-"))
    return scratch_path(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder.

    Later stages read the files, so a lost executor costs a task, not the
    lineage, and a table that is read twice is computed once.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
