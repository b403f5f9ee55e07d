"""Stores and exports.

A table of a store is a log of entries; an entry lists the folders of rows (parts) that make up one version. Folders are
never changed, so readers of an older version go on, and a failed write leaves no trace in the log. Adding rows writes
these rows alone; a change of some rows writes the partitions that hold them.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyspark import schemas
from tallyspark.operators.versioning import only_new, upsert
from tallyspark.sources import files

SLIM = ("registrants", "clients", "filings", "activities", "activity_extractions_rules")
#: Columns whose values divide the folders of a table; what has none is replaced as a whole.
PARTITIONS = {"filings": ("year", "quarter")}
#: A table of more parts is written as one again before the next write.
MOST_PARTS = 64


class Store:
    """Tables of a folder (of any Hadoop file system): TABLE/log/N.json lists the parts of version N, TABLE/rows/ID holds them."""

    def __init__(self, spark: SparkSession, folder: str, partitions: dict[str, tuple[str, ...]] = PARTITIONS):
        self.spark, self.folder, self.partitions = spark, folder, partitions

    def _latest(self, name: str) -> tuple[int, list[dict]]:
        """(version, parts): a part has its folder and the partitions in it that later parts hold instead."""
        found = [n for n in files.names(self.spark, f"{self.folder}/{name}/log") if n.endswith(".json")]
        return (int(found[-1][:-5]), json.loads(files.read_text(self.spark, f"{self.folder}/{name}/log/{found[-1]}"))) if found else (0, [])

    def _commit(self, name: str, version: int, parts: list[dict]) -> None:
        files.create_text(self.spark, f"{self.folder}/{name}/log/{version + 1:012d}.json", json.dumps(parts))

    def _write(self, name: str, df: DataFrame) -> dict:
        own = f"rows/{uuid.uuid4().hex}"
        by = [c for c in self.partitions.get(name, ()) if c in df.columns]
        (df.write.partitionBy(*by) if by else df.write).parquet(f"{self.folder}/{name}/{own}")
        return {"rows": own, "gone": []}

    def _these(self, name: str, values: Iterable[Iterable]) -> Column:
        """Whether a row is in one of these partitions; null is a value of its own."""
        any_of = F.lit(False)
        for v in values:
            one = F.lit(True)
            for c, x in zip(self.partitions[name], v):
                one = one & (F.col(c).isNull() if x is None else F.coalesce(F.col(c) == x, F.lit(False)))
            any_of = any_of | one
        return any_of

    def _rows(self, name: str, parts: list[dict]) -> DataFrame:
        schema, out = schemas.TABLES.get(name), None
        for part in parts:
            df = self.spark.read.parquet(f"{self.folder}/{name}/{part['rows']}")
            df = schemas.migrate(df, schema) if schema else df
            df = df.where(~self._these(name, part["gone"])) if part["gone"] else df
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table; an absent one is empty with its known schema."""
        parts = self._latest(name)[1]
        return self._rows(name, parts) if parts else self.spark.createDataFrame([], schemas.TABLES.get(name) or schema)

    def replace(self, name: str, df: DataFrame) -> None:
        version, _ = self._latest(name)
        self._commit(name, version, [self._write(name, df)])

    def append(self, name: str, df: DataFrame) -> None:
        version, parts = self._latest(name)
        if len(parts) >= MOST_PARTS:
            parts = [self._write(name, self._rows(name, parts))]
        self._commit(name, version, [*parts, self._write(name, df)])

    def replace_partitions(self, name: str, df: DataFrame, values: list[tuple]) -> None:
        """df in place of the rows of these partitions; nothing else is written."""
        version, parts = self._latest(name)
        if len(parts) >= MOST_PARTS:
            parts = [self._write(name, self._rows(name, parts))]
        gone = [{**p, "gone": sorted({*map(tuple, p["gone"]), *map(tuple, values)}, key=str)} for p in parts]
        self._commit(name, version, [*gone, self._write(name, df)])

    def insert_new(self, name: str, df: DataFrame, keys: list[str]) -> None:
        """Append the rows whose key is not stored yet."""
        self.append(name, only_new(df, self.read(name, df.schema), keys))

    def upsert(self, name: str, df: DataFrame, keys: list[str]) -> None:
        """Put rows in place of those of equal key."""
        old = self.read(name, df.schema)
        by = self.partitions.get(name)
        if not by:
            self.replace(name, upsert(old, df, keys))
            return
        # the partitions of the rows that go and of those that come; a table has few
        touched = old.join(df.select(*keys).distinct(), keys, "left_semi").select(*by).unionByName(df.select(*by)).distinct().collect()
        values = [tuple(r) for r in touched]
        self.replace_partitions(name, upsert(old.where(self._these(name, values)), df, keys), values)

    def partition_values(self, name: str, df: DataFrame) -> list[tuple]:
        return [tuple(r) for r in df.select(*self.partitions[name]).distinct().collect()]

    def of_partitions(self, name: str, values: list[tuple]) -> DataFrame:
        return self.read(name).where(self._these(name, values))

    def snapshot(self, to: str, tables: tuple[str, ...] = SLIM) -> None:
        """A copy of the current versions of some tables."""
        other = Store(self.spark, to, self.partitions)
        for t in tables:
            if self._latest(t)[1]:
                other.replace(t, self.read(t))


def write_document(path: str, parts: dict[str, DataFrame | object], most: int = 5000) -> None:
    """One JSON document of bounded result sets (dashboards, reports); a larger one is an error, not cut."""
    out = {}
    for name, part in parts.items():
        if isinstance(part, DataFrame):
            rows = [r.asDict(recursive=True) for r in part.limit(most + 1).collect()]
            if len(rows) > most:
                raise ValueError(f"{name} has more than {most} rows: write it as a table")
            part = rows
        out[name] = part
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, indent=2, ensure_ascii=False, default=str)


def read_documents(folder: str, names: list[str]) -> dict[str, object | None]:
    """The JSON documents of a folder; one that is missing or broken is None."""
    out: dict[str, object | None] = {}
    for n in names:
        try:
            with open(f"{folder}/{n}.json", encoding="utf-8") as f:
                out[n] = json.load(f)
        except (OSError, ValueError):
            out[n] = None
    return out


def write_report(path: str, title: str, sections: dict[str, DataFrame], most: int = 200) -> None:
    """A Markdown report: one table per section, of at most that many rows, with a line on what is left out."""
    lines = [f"# {title}", ""]
    for name, df in sections.items():
        rows = df.limit(most + 1).collect()
        lines += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join(str(v).replace("|", "\\|") for v in r) + " |" for r in rows[:most]]
        lines += ["", f"More rows than the {most} shown.", ""] if len(rows) > most else [""]
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines))
