"""Published versions of a warehouse.

A refresh never writes where readers read. It stages every table it rebuilds in
a folder of its own, ``<layer>/<table>/<run>``, and only when all of them are
there and their checks hold does it publish: one small file
``_versions/<number>.json`` that names the folder of every table. The file is
created only if that number is free, so of two refreshes that began at the same
version one fails, and readers switch all tables at once. A reader that has
resolved a version keeps it; a refresh that dies before it publishes leaves
nothing but folders that no version names, which :func:`clean` removes.

A table is a list of parts. Most have one. A refresh that replaces a few
partitions adds a part with the new ones and takes those values out of the
parts before it (``without``), which a reader plans as partition filters: the
replaced folders are not listed or read.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs
from .sinks import write_table

LOG = "_versions"
RUN = re.compile(r"\d{8}T\d{6}-[0-9a-f]{8}")
MAX_PARTS = 8  # beyond, a table is written whole


class PublishConflict(RuntimeError):
    """Another refresh published after this one had begun."""


@dataclass
class Version:
    """What is published: ``tables`` maps a name to {"fmt", "parts"}."""
    number: int = 0
    tables: dict = field(default_factory=dict)


def _number(name: str) -> int | None:
    stem, dot, end = name.partition(".")
    return int(stem) if dot and end == "json" and stem.isdigit() else None


def numbers(spark: SparkSession, warehouse: str) -> list[int]:
    found = [_number(n) for n, _ in fs.listing(spark, fs.join(warehouse, LOG))]
    return sorted(n for n in found if n is not None)


def _file(warehouse: str, number: int) -> str:
    return fs.join(warehouse, LOG, f"{number:08d}.json")


def load(spark: SparkSession, warehouse: str, number: int) -> Version | None:
    """A version, None if its file is not (or was never) written to the end."""
    try:
        got = json.loads(fs.read_text(spark, _file(warehouse, number)))
    except ValueError:
        return None
    return Version(got["version"], got["tables"])


def current(spark: SparkSession, warehouse: str) -> Version:
    """The newest whole version; number 0 without tables if there is none."""
    for n in reversed(numbers(spark, warehouse)):
        got = load(spark, warehouse, n)
        if got is not None:
            return got
    return Version()


def _is(values: dict) -> Column:
    """Whether a row is in the partition with these values (as text, None for NULL)."""
    out = F.lit(True)
    for c, v in values.items():
        out = out & (F.col(c).isNull() if v is None else F.coalesce(F.col(c).cast("string") == F.lit(v), F.lit(False)))
    return out


def _part(spark: SparkSession, warehouse: str, fmt: str, part: dict) -> DataFrame:
    df = spark.read.format(fmt).load(fs.join(warehouse, part["path"]))
    for values in part.get("without", ()):
        df = df.where(~_is(values))
    return df


def read(spark: SparkSession, warehouse: str, entry: dict) -> DataFrame:
    """The table that a version's entry describes."""
    parts = [_part(spark, warehouse, entry["fmt"], p) for p in entry["parts"]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def select_sql(warehouse: str, entry: dict) -> str:
    """The same as SQL text, for a view over the published files."""
    def one(part):
        text = f"SELECT * FROM {entry['fmt']}.`{fs.join(warehouse, part['path'])}`"
        gone = []
        for values in part.get("without", ()):
            gone.append(" AND ".join(f"`{c}` IS NULL" if v is None else
                                     f"coalesce(cast(`{c}` AS string) = {quote(v)}, false)" for c, v in values.items()))
        return text + "".join(f" {'AND' if k else 'WHERE'} NOT ({g})" for k, g in enumerate(gone))
    columns = entry.get("columns")
    if len(entry["parts"]) == 1:
        return one(entry["parts"][0])
    names = ", ".join(f"`{c}`" for c in columns)
    return " UNION ALL ".join(f"SELECT {names} FROM ({one(p)})" for p in entry["parts"])


def quote(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


class Staging:
    """One refresh: tables written aside, then published together."""

    def __init__(self, spark: SparkSession, warehouse: str, fmt: str = "parquet"):
        self.spark, self.warehouse, self.fmt = spark, warehouse, fmt
        self.base = current(spark, warehouse)
        self.run = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
        self.entries: dict[str, dict] = {}

    def _path(self, name: str) -> str:
        layer, table = name.split(".", 1)
        # Delta has versions of its own, written to in place
        return f"{layer}/{table}" if self.fmt == "delta" else f"{layer}/{table}/{self.run}"

    def write(self, name: str, df: DataFrame, partition_by=(), change_feed: bool = False) -> None:
        """Stage the whole of a table."""
        write_table(df, fs.join(self.warehouse, self._path(name)), fmt=self.fmt, partition_by=partition_by, change_feed=change_feed)
        self.entries[name] = {"fmt": self.fmt, "columns": df.columns, "parts": [{"path": self._path(name)}]}

    def write_partitions(self, name: str, df: DataFrame, partition_by, replaced: list[dict]) -> bool:
        """Stage ``df`` in place of the partitions ``replaced`` (their values as
        text by column) of the published table. A partition that ``df`` holds no
        rows of is gone afterwards. False if nothing was staged because the
        table has too many parts already, or none."""
        old = self.base.tables.get(name)
        if self.fmt == "delta" or old is None or len(old["parts"]) >= MAX_PARTS:
            return False
        path = fs.join(self.warehouse, self._path(name))
        write_table(df, path, fmt=self.fmt, partition_by=partition_by)
        parts = [{**p, "without": [*p.get("without", ()), *(r for r in replaced if r not in p.get("without", ()))]}
                 for p in old["parts"]]
        if any("=" in folder for folder, _ in fs.listing(self.spark, path)):  # else there are only deletions
            parts.append({"path": self._path(name)})
        self.entries[name] = {**old, "parts": parts}
        return True

    def read(self, name: str) -> DataFrame:
        """A staged table."""
        return read(self.spark, self.warehouse, self.entries[name])

    def publish(self) -> Version:
        """Make the staged tables, with all others as they were, the next
        version. Raises PublishConflict if the version this refresh began at is
        not the newest any more; nothing is published then."""
        known = numbers(self.spark, self.warehouse)
        if current(self.spark, self.warehouse).number != self.base.number:
            raise PublishConflict(f"version {self.base.number} is not the newest of {self.warehouse} any more")
        new = Version(max(known, default=0) + 1, {**self.base.tables, **self.entries})
        text = json.dumps({"version": new.number, "base": self.base.number, "run": self.run, "tables": new.tables}, indent=1)
        if not fs.create_text(self.spark, _file(self.warehouse, new.number), text):
            raise PublishConflict(f"version {new.number} of {self.warehouse} was published meanwhile")
        return new

    def abandon(self) -> None:
        """Remove what was staged."""
        if self.fmt != "delta":
            for name in self.entries:
                fs.delete(self.spark, fs.join(self.warehouse, self._path(name)))


def clean(spark: SparkSession, warehouse: str, keep: int = 2, abandoned_hours: float = 24.0) -> list[str]:
    """Remove all but the newest ``keep`` versions, with the table folders that
    only they name, and folders no version names that have not changed for
    ``abandoned_hours`` (refreshes that died; a running one is younger). Returns
    the folders removed. Readers of a removed version fail on their next file."""
    loaded = {n: load(spark, warehouse, n) for n in numbers(spark, warehouse)}
    whole = [n for n, v in loaded.items() if v is not None]
    kept = whole[-max(keep, 1):]

    def folders(of):
        return {p["path"] for n in of for t in loaded[n].tables.values() for p in t["parts"]}

    named = folders(kept)
    gone = folders(n for n in whole if n not in kept) - named
    for layer, _ in fs.listing(spark, warehouse):
        for table, _ in fs.listing(spark, fs.join(warehouse, layer)) if not layer.startswith("_") else ():
            for run, changed in fs.listing(spark, fs.join(warehouse, layer, table)):
                path = f"{layer}/{table}/{run}"
                if RUN.fullmatch(run) and path not in named and time.time() - changed > abandoned_hours * 3600:
                    gone.add(path)
    for n in loaded:  # the pointers first: no reader finds a version whose folders are going
        if kept and n < kept[0]:
            fs.delete(spark, _file(warehouse, n))
    for path in gone:
        fs.delete(spark, fs.join(warehouse, path))
    return sorted(gone)
