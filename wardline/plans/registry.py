"""Named views: a stored query with a comment, checks and partition columns.

A view is a plain function ``fn(cat) -> DataFrame`` registered with
:func:`view`. ``cat`` (a :class:`Catalog`) resolves upstream names either to
tables the pipeline has already written (so each layer reads its inputs from
storage, which also cuts lineage) or, when nothing is written, to the
upstream view built lazily in the same plan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Check
from ..sources import fs, versions
from ..sources.bronze import bronze_table
from ..sources.tables import Tables

LAYERS = ("bronze", "silver", "gold", "graphql")


@dataclass
class ViewSpec:
    name: str
    fn: Callable
    inputs: tuple[str, ...]
    comment: str = ""
    checks: tuple[Check, ...] = ()
    partition_by: tuple[str, ...] = ()
    uses_as_of: bool = False
    layer: str = field(init=False)

    def __post_init__(self):
        self.layer = self.name.split(".", 1)[0]


VIEWS: dict[str, ViewSpec] = {}


def view(name: str, inputs=(), comment: str = "", checks=(), partition_by=(), uses_as_of=False):
    """Register ``fn(cat) -> DataFrame`` as view ``layer.name``."""
    def deco(fn):
        VIEWS[name] = ViewSpec(name, fn, tuple(inputs), comment, tuple(checks), tuple(partition_by),
                               uses_as_of)
        fn.spec = VIEWS[name]
        return fn
    return deco


def sql_view(name: str, sql: str, inputs, comment: str = "", checks=(), partition_by=(),
             uses_as_of: bool = False):
    """Register a view written as Spark SQL text.

    Upstream tables are referred to by their layer-qualified names
    (``silver.encounter_silver``); each is bound to the upstream DataFrame
    through ``spark.sql``'s DataFrame arguments, so the SQL runs over
    whatever the catalog resolves (written tables or lazy plans). ``:as_of``
    in the text is bound as a date parameter when ``uses_as_of`` is set
    (``current_date()`` when the catalog has no ``as_of``).
    """
    inputs = tuple(inputs)
    # Longest names first so that no name is replaced inside a longer one.
    order = sorted(inputs, key=len, reverse=True)
    text = sql
    for n in order:
        text = text.replace(n, "{" + n.replace(".", "__") + "}")

    def fn(cat):
        frames = {n.replace(".", "__"): cat.table(n) for n in inputs}
        body, args = text, None
        if uses_as_of:
            if cat.as_of is None:
                body = body.replace(":as_of", "current_date()")
            else:
                args = {"as_of": cat.as_of}  # bound as a DATE literal
        return cat.spark.sql(body, args=args, **frames)

    fn.__name__ = name.split(".", 1)[-1]
    return view(name, inputs, comment, checks, partition_by, uses_as_of)(fn)


def enforce(df: DataFrame, checks, stored: bool = True) -> DataFrame:
    """Keep rows passing every ``drop`` check: a plain filter, which a scan can
    evaluate if the view reads ``stored`` tables; else the values are made in the
    same plan, and each check names them once."""
    cond = None
    for c in checks:
        if c.action == "drop":
            one = c.passes if stored else c.passes_once
            cond = one if cond is None else (cond & one)
    return df if cond is None else df.where(cond)


class Catalog:
    """Resolves layer-qualified names to DataFrames.

    ``root``: folder of input tables (``<root>/<name>.parquet``).
    ``warehouse``: folder of a warehouse; tables of the version published there
    when the catalog is made are read back instead of rebuilt, whatever is
    published later. Tables written by hand at ``<warehouse>/<layer>/<name>`` are
    found where nothing is published.
    ``staged``: tables of a refresh that is under way, read before published ones.
    ``published=False`` leaves published tables out of account.
    ``as_of``: the date that stands in for ``current_date()`` so results are
    reproducible; ``None`` means ``current_date()`` of each execution.
    ``calendar``: fixed ``(start, end)`` of the date dimension; by default it
    covers whole years around the data.
    """

    def __init__(self, spark: SparkSession, root: str, warehouse: str | None = None,
                 as_of: _dt.date | None = None, fmt: str = "parquet", calendar=None,
                 staged: versions.Staging | None = None, published: bool = True):
        self.spark = spark
        self.inputs = Tables(spark, root)
        self.warehouse = warehouse
        self.as_of = as_of
        self.calendar = calendar  # (start, end) for gold.dim_date; None: cover the data
        self.fmt = fmt
        self.staged = staged
        if not published or not warehouse:
            self.version = versions.Version()
        else:
            self.version = staged.base if staged else versions.current(spark, warehouse)
        self._by_hand = published and not self.version.number
        self._cache: dict[str, DataFrame] = {}

    def entry(self, name: str) -> dict | None:
        """Where the table is stored: a version's entry, None if it is not."""
        if self.staged is not None and name in self.staged.entries:
            return self.staged.entries[name]
        if name in self.version.tables:
            return self.version.tables[name]
        if self.warehouse and self._by_hand:
            path = name.replace(".", "/", 1)
            mark = "_delta_log" if self.fmt == "delta" else "_SUCCESS"
            if fs.exists(self.spark, fs.join(self.warehouse, path, mark)):
                return {"fmt": self.fmt, "parts": [{"path": path}]}
        return None

    def is_written(self, name: str) -> bool:
        return self.entry(name) is not None

    def as_of_col(self):
        """``as_of`` as a date Column (``current_date()`` when unset)."""
        return F.current_date() if self.as_of is None else F.lit(str(self.as_of)).cast("date")

    def table(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        entry = self.entry(name)
        if entry is not None:
            df = versions.read(self.spark, self.warehouse, entry)
        elif name.startswith("bronze."):
            df = bronze_table(self.inputs, name.split(".", 1)[1],
                              resolve=lambda n: self.table("bronze." + n))
        elif name in VIEWS:
            df = self.build(name)
        else:
            raise KeyError(name)
        self._cache[name] = df
        return df

    def build(self, name: str) -> DataFrame:
        """The view's query with its drop-checks applied (lazy)."""
        spec = VIEWS[name]
        return enforce(spec.fn(self), spec.checks, stored=any(self.is_written(i) for i in spec.inputs))


class Given:
    """A catalog stand-in that serves fixed DataFrames to a view function
    (used to run a view on a subset of its inputs)."""

    def __init__(self, frames: dict, as_of_col=None, calendar=None):
        self.frames = frames
        self._as_of_col = as_of_col
        self.calendar = calendar

    def table(self, name: str) -> DataFrame:
        return self.frames[name]

    def as_of_col(self):
        return F.current_date() if self._as_of_col is None else self._as_of_col


def topo_order(names=None) -> list[str]:
    """Views in dependency order (inputs first)."""
    names = list(names or VIEWS)
    seen, out = set(), []

    def visit(n):
        if n in seen or n not in VIEWS:
            return
        seen.add(n)
        for i in VIEWS[n].inputs:
            visit(i)
        out.append(n)

    for n in names:
        visit(n)
    return out
