"""Raw visit files: discovery, database type and grouping by schema."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths of every Parquet file below ``root`` (contents are not read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(root).select("path"))


def db_type_of(path: str) -> str:
    """Source database named by a path."""
    text = path.lower()
    return next((name.upper() for name in ("sedd", "sasd") if name in text), "SID")


def db_type_column(path: Column) -> Column:
    """The same rule as a column, for scans that mix databases."""
    text = F.lower(path)
    return (F.when(text.contains("sedd"), "SEDD").when(text.contains("sasd"), "SASD")
            .otherwise("SID"))


def below(path: str, root: str) -> str:
    """The part of a file's path under ``root``, whatever scheme either is written with."""
    bare = re.sub("^[a-z0-9]+:/+", "/", root).rstrip("/") + "/"
    return path.partition(bare)[2] or path


def state_year_of(path: str, states: frozenset[str]) -> tuple[str | None, int | None]:
    """State code and year spelled out in a path, where there are any."""
    words = re.split(r"[^A-Za-z0-9]+", path)
    state = next((w for w in words if w in states), None)
    year = next((int(w) for w in words if re.fullmatch(r"(19|20)\d\d", w)), None)
    return state, year


@dataclass(frozen=True)
class FileGroup:
    """Files that share a database type, a schema and any map overrides."""

    db_type: str
    state: str | None
    year: int | None
    paths: tuple[str, ...]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(*self.paths)


def _read_footers(batches: Iterator) -> Iterator:
    import pandas as pd
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        schemas = []
        for path in batch["path"]:
            filesystem, inner = fs.FileSystem.from_uri(
                re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", path)))
            with filesystem.open_input_file(inner) as handle:
                fields = pq.read_schema(handle)
            schemas.append("\n".join(f"{f.name}\t{f.type}" for f in fields))
        yield pd.DataFrame({"path": batch["path"], "columns": schemas})


def group_by_schema(spark: SparkSession, root: str, *,
                    places: frozenset[str] | None = None) -> list[FileGroup]:
    """Group the files below ``root`` so that each group maps to one plan.

    Footers are read by tasks; the driver receives one short line per file,
    which is what it holds anyway to plan a scan.  Each schema's text comes back
    once.  ``places`` (state codes) splits groups by the state and year that the
    folders below ``root`` name, for maps with overrides.
    """
    footers = list_files(spark, root).repartition("path").mapInPandas(_read_footers, "path string, columns string")
    same = footers.groupBy("columns").agg(F.collect_list("path").alias("paths"))  # paths as any scan plan holds
    groups: dict[tuple, list[str]] = {}
    for row in same.toLocalIterator():
        for path in row.paths:
            inside = below(path, root)
            state, year = (None, None) if places is None else state_year_of(inside, places)
            groups.setdefault((db_type_of(path), state, year, row.columns), []).append(path)
    if not groups:
        raise FileNotFoundError(f"no parquet files below {root}")
    ordered = sorted(groups.items(), key=lambda item: min(item[1]))
    return [FileGroup(db, state, year, tuple(sorted(paths)))
            for (db, state, year, _), paths in ordered]
