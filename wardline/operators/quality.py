"""Row-level data-quality checks (``CONSTRAINT name CHECK (p) ON MISMATCH DROP``).

A check sees the *output* columns of a view. A row mismatches when its
predicate is FALSE. What a NULL predicate means is the check's
``null_policy``: ``"pass"`` (SQL CHECK semantics, the default) keeps the
row, ``"drop"`` treats NULL as a mismatch.

The kept rows are a plain ``filter``, so Catalyst pushes it into the scan or
below joins like any other predicate. Violation counts are gathered in the
same job that writes the kept rows, via ``DataFrame.observe`` (no second
pass over the data), or by one grouped aggregate when counts are wanted as a
DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("drop", "fail", "warn")
NULL_POLICIES = ("pass", "drop")


@dataclass(frozen=True)
class Check:
    name: str
    predicate: str | Column
    action: str = "drop"
    null_policy: str = "pass"
    # Columns whose NULL is exactly what makes the predicate NULL (true for a
    # comparison of one column with a literal). Lets the NULL test be written
    # on the columns, which parquet can evaluate, instead of on the predicate.
    null_columns: tuple = ()
    # The checked value is made in the view itself (parsed text, say), so that
    # there is nothing a scan could evaluate: the test is written with one copy
    # of the predicate, since each copy would make the value again.
    computed: bool = False

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}")
        if self.null_policy not in NULL_POLICIES:
            raise ValueError(f"null_policy must be one of {NULL_POLICIES}")

    @property
    def condition(self) -> Column:
        p = self.predicate
        return F.expr(p) if isinstance(p, str) else p

    @property
    def passes(self) -> Column:
        """TRUE where the row satisfies the check (NULL handled per policy).

        Written as ``p OR p IS NULL`` rather than ``coalesce(p, true)``: Spark
        simplifies the former and can still push it into the parquet scan.
        """
        p = self.condition
        if self.computed:
            return self.passes_once
        if self.null_policy == "pass":
            if self.null_columns:
                is_null = None
                for c in self.null_columns:
                    is_null = F.col(c).isNull() if is_null is None else (is_null | F.col(c).isNull())
                return p | is_null
            return p | p.isNull()
        return p & p.isNotNull()

    @property
    def passes_once(self) -> Column:
        """The same with one copy of the predicate, for values that are made in
        the same plan; a parquet scan cannot evaluate this form."""
        return F.coalesce(self.condition, F.lit(self.null_policy == "pass"))

    @property
    def violates(self) -> Column:
        return ~self.passes


class CheckFailed(Exception):
    pass


def apply_checks(df: DataFrame, checks, observe_as: str | None = None):
    """Apply checks; return ``(kept, observation)``.

    ``drop`` checks filter rows out. ``warn`` checks only count. ``fail``
    checks count too; call :func:`raise_on_failures` after the action that
    consumed ``kept`` to raise if any row failed.
    ``observation`` (a ``pyspark.sql.Observation``) holds, once ``kept`` has
    been consumed by an action, the input row count and each check's
    violation count, computed in that same job.
    """
    checks = list(checks)
    if not checks:
        return df, None
    obs = Observation(observe_as or "checks")
    metrics = [F.count(F.lit(1)).alias("_input_rows")]
    metrics += [F.count_if(c.violates).alias(c.name) for c in checks]
    observed = df.observe(obs, *metrics)
    keep = None
    for c in checks:
        if c.action == "drop":
            keep = c.passes if keep is None else (keep & c.passes)
    kept = observed if keep is None else observed.where(keep)
    return kept, obs


def raise_on_failures(obs: Observation, checks) -> None:
    vals = obs.get
    bad = {c.name: vals.get(c.name, 0) for c in checks if c.action == "fail" and vals.get(c.name, 0)}
    if bad:
        raise CheckFailed(f"checks failed: {bad}")


def violation_counts(df: DataFrame, checks) -> DataFrame:
    """One row per check: ``check_name``, ``violations``, ``input_rows``.

    A single aggregate pass (partial on each partition, then one tiny final
    step), unpivoted into rows.
    """
    checks = list(checks)
    agg = df.agg(F.count(F.lit(1)).alias("input_rows"),
                 *[F.count_if(c.violates).alias(f"v{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(f"v{i}").alias("violations"))
                     for i, c in enumerate(checks)])
    return (agg.select(F.inline(rows), "input_rows")
               .select("check_name", "violations", "input_rows"))


def split_by_checks(df: DataFrame, checks):
    """``(kept, dropped)``: rows passing every drop-check and the complement.

    ``dropped`` carries a ``failed_checks`` array naming the checks each row
    failed, for a quarantine table.
    """
    checks = [c for c in checks if c.action == "drop"]
    if not checks:
        return df, df.limit(0).withColumn("failed_checks", F.array().cast("array<string>"))
    all_pass = None
    for c in checks:
        all_pass = c.passes if all_pass is None else (all_pass & c.passes)
    failed = F.filter(F.array(*[F.when(c.violates, F.lit(c.name)) for c in checks]),
                      lambda x: x.isNotNull())
    return df.where(all_pass), df.where(~all_pass).withColumn("failed_checks", failed)
