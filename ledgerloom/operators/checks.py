"""Data-quality checks.

A check names a table and says which rows fail and how many may. ``evaluate``
runs any number of them as one query, with as few passes as their kinds allow:

* row checks on one table share a single aggregation,
* checks for accepted values on one table share a grouping of the bad values alone,
* checks per key (uniqueness, sums and ratios over the rows of a key) that use
  the same table and key share one grouping,
* a foreign key is first counted per key value, so the join with the parent
  handles each value once, however many rows carry it.

Counting rules: ``unique`` counts duplicated values, ``accepted_values``
distinct bad values, foreign keys and row rules count rows, rules over the rows
of a key count keys. NULL passes everything but ``not_null``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.measures import older_than, outside_tolerance
from ledgerloom.operators.matching import without_parent
from ledgerloom.sources.seeds import in_plan_table

Tables = Mapping[str, DataFrame]

RESULT_COLUMNS = (
    "check", "layer", "kind", "dimension", "severity", "n_total", "n_failed", "pct_failed", "verdict",
)

#: Names the folders of failing rows that were written together.
FAILED_CHECK = "failed_check"

_LABELS = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("warn_above", T.LongType()),
        T.StructField("error_above", T.LongType()),
        T.StructField("error_share", T.DecimalType(9, 6)),
    ]
)


@dataclass(frozen=True)
class Limits:
    """``warn`` above one count, ``error`` above another or above a share of the total."""

    warn_above: int | None = None
    error_above: int | None = 0
    error_share: Decimal | None = None

    @property
    def severity(self) -> str:
        return "warn" if self.warn_above is not None else "error"


@dataclass(frozen=True)
class Check:
    name: str
    layer: str
    table: str
    kind: str
    dimension: str
    limits: Limits = field(default_factory=Limits)

    def named(self, name: str) -> Check:
        return replace(self, name=name)

    @property
    def shares(self) -> tuple:
        """Checks with the same value are counted in one pass."""
        raise NotImplementedError

    def counted_with(self, group: Sequence, tables: Tables) -> tuple[DataFrame, list]:
        """What the pass aggregates, and total and failures of every check as aggregates of it."""
        raise NotImplementedError

    def failing(self, tables: Tables) -> DataFrame:
        """The rows to keep for inspection."""
        raise NotImplementedError

    @property
    def failing_shares(self) -> tuple:
        """Checks with the same value have their failing rows written in one pass."""
        return ("alone", self.name)

    def failing_of(self, group: Sequence, tables: Tables) -> DataFrame:
        """The rows to look for failures of a group in, in which every check's ``bad`` can be asked."""
        raise NotImplementedError


@dataclass(frozen=True, kw_only=True)
class RowCheck(Check):
    """Counted by one pair of aggregates over the table."""

    bad: Column | None = None
    total: Column = field(default_factory=lambda: F.count(F.lit(1)))
    failed: Column | None = None
    bad_values_of: str | None = None

    @property
    def shares(self) -> tuple:
        return ("rows", self.table)

    def counted_with(self, group: Sequence[RowCheck], tables: Tables) -> tuple[DataFrame, list]:
        table = tables[self.table]
        return table, [check.aggregates(table) for check in group]

    def aggregates(self, table: DataFrame) -> tuple[Column, Column]:
        return self.total, self.failed if self.failed is not None else F.count_if(self.bad)

    @property
    def failing_shares(self) -> tuple:
        alone = self.bad is None or self.bad_values_of is not None
        return ("alone", self.name) if alone else ("rows", self.table)

    def failing_of(self, group: Sequence[RowCheck], tables: Tables) -> DataFrame:
        return tables[self.table]

    def failing(self, tables: Tables) -> DataFrame:
        table = tables[self.table]
        if self.bad is None:
            total, failed = self.aggregates(table)
            summary = table.agg(total.alias("n_total"), failed.alias("n_failed"))
            return summary.where("n_failed > 0")
        rows = table.where(self.bad)
        if self.bad_values_of:
            return rows.groupBy(self.bad_values_of).agg(F.count(F.lit(1)).alias("n_records"))
        return rows


@dataclass(frozen=True, kw_only=True)
class ColumnsCheck(RowCheck):
    """All ``required`` columns exist, others may too."""

    required: Sequence[str] = ()

    def aggregates(self, table: DataFrame) -> tuple[Column, Column]:
        missing = set(self.required) - set(table.columns)
        return F.lit(len(self.required)), F.lit(len(missing))

    def failing(self, tables: Tables) -> DataFrame:
        spark = tables[self.table].sparkSession
        return missing_columns(tables[self.table], self.required, spark)


@dataclass(frozen=True, kw_only=True)
class ValuesCheck(RowCheck):
    """Counts the distinct bad values of a column.

    Only bad values are grouped, those of all checks on a table together; a distinct count per
    check would make a row per check out of every row of the table. Rows without a bad value are
    one group, and no entry is made for them.
    """

    @property
    def shares(self) -> tuple:
        return ("values", self.table)

    def counted_with(self, group: Sequence[ValuesCheck], tables: Tables) -> tuple[DataFrame, list]:
        def entry(position: int, value: Column) -> Column:
            return F.struct(F.lit(position).alias("position"), value.cast("string").alias("value"))

        # Position -1 stands for the rows themselves, the others for checks they fail.
        found = [F.when(k.bad, entry(i, F.col(k.bad_values_of))) for i, k in enumerate(group)]
        bad = F.when(any_bad(group), F.array(*found))
        rows = tables[self.table].groupBy(bad.alias("bad")).agg(F.count(F.lit(1)).alias("n"))
        every = F.array(entry(-1, F.lit(None)))
        entries = F.when(F.col("bad").isNull(), every).otherwise(F.concat(every, F.col("bad")))
        entries = rows.select("n", F.explode(entries).alias("entry")).where("entry IS NOT NULL")
        values = entries.groupBy("entry.position", "entry.value").agg(F.sum("n").alias("n"))
        total = F.coalesce(F.sum(F.when(F.col("position") == -1, F.col("n"))), F.lit(0))
        return values, [(total, F.count_if(F.col("position") == i)) for i in range(len(group))]


@dataclass(frozen=True, kw_only=True)
class KeyCheck(Check):
    """A rule on an aggregate over the rows of each key."""

    keys: tuple[str, ...]
    per_key: Mapping[str, Column]
    rows: Column | None = None
    total: Column
    bad: Column
    failed: Column | None = None

    @property
    def shares(self) -> tuple:
        return ("key", self.table, self.keys)

    def counted_with(self, group: Sequence[KeyCheck], tables: Tables) -> tuple[DataFrame, list]:
        """Group once by the key with the aggregates of every check.

        These are NULL or zero on rows outside a check's own ``rows``, so a
        filter can be put in front only if every check has one. Equal names
        stand for equal aggregates.
        """
        table = tables[self.table]
        scopes = [check.rows for check in group]
        if all(scope is not None for scope in scopes):
            table = table.where(reduce(lambda a, b: a | b, scopes))
        merged = {alias: agg for check in group for alias, agg in check.per_key.items()}
        return _per_key(table, self.keys, merged), [check.aggregates() for check in group]

    @property
    def failing_shares(self) -> tuple:
        return self.shares

    def failing_of(self, group: Sequence[KeyCheck], tables: Tables) -> DataFrame:
        return self.counted_with(group, tables)[0]

    def aggregates(self) -> tuple[Column, Column]:
        return self.total, self.failed if self.failed is not None else F.count_if(self.bad)

    def failing(self, tables: Tables) -> DataFrame:
        table = tables[self.table]
        table = table if self.rows is None else table.where(self.rows)
        return _per_key(table, self.keys, self.per_key).where(self.bad)


@dataclass(frozen=True, kw_only=True)
class ParentCheck(Check):
    """Every key occurs in the parent table."""

    key: str
    parent: str
    parent_key: str
    null_is_orphan: bool = False

    def failing(self, tables: Tables) -> DataFrame:
        child = tables[self.table].select(self.key)
        return without_parent(
            child, tables[self.parent], self.key, self.parent_key, self.null_is_orphan
        )

    @property
    def shares(self) -> tuple:
        return ("parent", self.table, self.key, self.parent, self.parent_key)

    def counted_with(self, group: Sequence[ParentCheck], tables: Tables) -> tuple[DataFrame, list]:
        return self.keyed(tables), [check.aggregates() for check in group]

    def aggregates(self) -> tuple[Column, Column]:
        counted = F.lit(True) if self.null_is_orphan else F.col(self.key).isNotNull()
        n = F.when(counted, F.col("n"))
        orphans = F.when(F.col("known").isNull(), n)
        return F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.sum(orphans), F.lit(0))

    def keyed(self, tables: Tables) -> DataFrame:
        """Each key value with its number of rows, and whether the parent knows it."""
        values = tables[self.table].groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
        parent = tables[self.parent].select(F.col(self.parent_key).alias(self.key))
        return values.join(parent.distinct().withColumn("known", F.lit(True)), self.key, "left")


def any_bad(group: Sequence) -> Column:
    """Whether a row fails any check of a group."""
    return reduce(lambda a, b: a | b, [check.bad for check in group])


# --- kinds of checks ---------------------------------------------------------


def not_null(
    layer: str, table: str, column: str, share: str | None = None, instead: str | None = None
) -> Check:
    """No NULL, or at most ``share`` of all rows; a value in the column ``instead`` will do."""
    limits = Limits() if share is None else Limits(error_above=None, error_share=Decimal(share))
    missing = F.col(column).isNull()
    return RowCheck(
        f"not_null_{table}_{column}", layer, table, "not_null", "completeness", limits,
        bad=missing & F.col(instead).isNull() if instead else missing,
    )


def accepted_values(layer: str, table: str, column: str, values: Sequence[str]) -> Check:
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return ValuesCheck(
        f"accepted_values_{table}_{column}", layer, table, "accepted_values", "validity",
        bad=bad, bad_values_of=column,
    )


def expression_is_true(
    layer: str, table: str, name: str, holds: Column, limits: Limits = Limits()
) -> Check:
    return RowCheck(
        f"expression_{table}_{name}", layer, table, "expression_is_true", "validity", limits,
        bad=F.coalesce(~holds, F.lit(False)),
    )


def value_between(
    layer: str,
    table: str,
    column: str,
    low: int,
    high: int,
    limits: Limits = Limits(),
    only: Column | None = None,
    name: str | None = None,
    instead: str | None = None,
) -> Check:
    """Inclusive range; ``only`` restricts the rows it applies to.

    ``instead`` names the column that holds the value where ``column`` can't.
    """
    scope = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    outside = (F.col(column) < low) | (F.col(column) > high)
    if instead:
        outside = F.coalesce(outside, (F.col(instead) < low) | (F.col(instead) > high))
    return RowCheck(
        name or f"value_between_{table}_{column}_{low}_{high}", layer, table, "value_between",
        "validity", limits,
        bad=scope & F.coalesce(outside, F.lit(False)), total=F.count_if(scope),
    )


def matches_mostly(layer: str, table: str, column: str, matches: Column, share: str) -> Check:
    """At most ``share`` of the non-NULL values fail to match."""
    return RowCheck(
        f"matches_{table}_{column}", layer, table, "matches", "validity",
        Limits(error_above=None, error_share=Decimal(share)),
        bad=F.coalesce(~matches, F.lit(False)), total=F.count(column),
    )


def complete_mostly(layer: str, table: str, column: str, missing: Column, share: str) -> Check:
    """At most ``share`` of all rows are ``missing``, which may include blanks and empty lists."""
    return RowCheck(
        f"complete_{table}_{column}", layer, table, "complete", "completeness",
        Limits(error_above=None, error_share=Decimal(share)), bad=missing,
    )


def row_count_between(layer: str, table: str, low: int, high: int) -> Check:
    n = F.count(F.lit(1))
    return RowCheck(
        f"row_count_{table}", layer, table, "row_count", "completeness",
        failed=F.when(n.between(low, high), 0).otherwise(1),
    )


def not_dropped(layer: str, table: str, previous_count: Column, ratio: str) -> Check:
    """At least ``ratio`` times the rows of the load before; passes if there was none."""
    n = F.count(F.lit(1)).cast("decimal(20,0)")
    before = F.coalesce(previous_count, F.lit(0)).cast("decimal(20,0)")
    return RowCheck(
        f"not_dropped_{table}", layer, table, "not_dropped", "consistency",
        failed=F.when((before > 0) & (n < before * F.lit(Decimal(ratio))), 1).otherwise(0),
    )


def fresh(
    layer: str,
    table: str,
    column: str,
    as_of: dt.datetime,
    error_hours: int,
    warn_hours: int | None = None,
    empty_is_stale: bool = False,
) -> Check:
    """Age of the newest row; ``n_failed`` is the number of age limits it is past."""
    newest = F.max(column)
    hours = [error_hours] if warn_hours is None else [warn_hours, error_hours]
    late = [F.coalesce(older_than(newest, as_of, h), F.lit(empty_is_stale)).cast("int") for h in hours]
    limits = Limits() if warn_hours is None else Limits(warn_above=0, error_above=1)
    return RowCheck(
        f"fresh_{table}_{column}", layer, table, "fresh", "timeliness", limits,
        failed=reduce(lambda a, b: a + b, late),
    )


def required_columns(layer: str, table: str, columns: Sequence[str]) -> Check:
    return ColumnsCheck(
        f"required_columns_{table}", layer, table, "required_columns", "validity",
        required=tuple(columns),
    )


def missing_columns(df: DataFrame, required: Sequence[str], spark) -> DataFrame:
    """Names that ``df`` lacks, one per row."""
    missing = [(c,) for c in required if c not in set(df.columns)]
    return spark.createDataFrame(missing, "missing_column string")


def unique(layer: str, table: str, column: str, count_rows: bool = False) -> Check:
    """Counts duplicated values, or with ``count_rows`` the rows that carry them."""
    duplicated = (F.col("n_records") > 1) & F.col(column).isNotNull()
    n = F.when(F.col(column).isNotNull(), F.col("n_records"))
    rows = F.coalesce(F.sum(F.when(duplicated, F.col("n_records"))), F.lit(0))
    return KeyCheck(
        f"unique_{table}_{column}", layer, table, "unique", "uniqueness",
        keys=(column,), per_key={"n_records": F.count(F.lit(1))},
        total=F.coalesce(F.sum(n), F.lit(0)), bad=duplicated,
        failed=rows if count_rows else None,
    )


def unique_combination(layer: str, table: str, *columns: str) -> Check:
    """Counts duplicated combinations; here a NULL is a value like any other."""
    return KeyCheck(
        f"unique_{table}_{'_'.join(columns)}", layer, table, "unique_combination", "uniqueness",
        keys=columns, per_key={"n_records": F.count(F.lit(1))},
        total=F.coalesce(F.sum("n_records"), F.lit(0)), bad=F.col("n_records") > 1,
    )


def component_sum_at_most(
    layer: str,
    table: str,
    key: str,
    name: str,
    amount: str,
    components: Sequence[str],
    bound: int,
    limits: Limits,
    instead: str | None = None,
) -> Check:
    """Keys that have all components, and whose components sum to more than ``bound``.

    An amount in the column ``instead`` adds to the sum as a double.
    """
    chosen = F.col(name).isin(*components)
    # One flag per component adds up to the distinct count and combines before the shuffle.
    present = [F.max(F.when(F.col(name) == c, 1).otherwise(0)) for c in components]
    total, n_present = (f"{part}_{'_'.join(components)}" for part in (amount, "n"))
    complete = F.col(n_present) == len(components)
    above = F.col(total) > bound
    more = {}
    if instead:
        large = f"{instead}_{'_'.join(components)}"
        more[large] = F.sum(F.when(chosen, F.col(instead)))
        both = F.col(large) + F.coalesce(F.col(total).cast("double"), F.lit(0.0))
        above = F.when(F.col(large).isNotNull(), both > bound).otherwise(above)
    return KeyCheck(
        f"component_sum_{table}_{amount}", layer, table, "component_sum", "consistency", limits,
        keys=(key,),
        per_key={
            total: F.sum(F.when(chosen, F.col(amount))),
            n_present: reduce(lambda a, b: a + b, present),
            **more,
        },
        rows=chosen, total=F.count_if(complete), bad=complete & above,
    )


def ratio_consistent(
    layer: str,
    table: str,
    key: str,
    name: str,
    amount: str,
    whole: str,
    part: str,
    ratio: str,
    relative: str,
    absolute: str,
    limits: Limits,
    instead: str | None = None,
) -> Check:
    """Keys where ``whole`` is not ``part`` times ``ratio`` within the tolerance.

    Where the column ``instead`` holds one of the two, they are compared as doubles.
    """
    both = F.col(whole).isNotNull() & F.col(part).isNotNull()
    off = outside_tolerance(whole, part, ratio, relative, absolute)
    more = {}
    if instead:
        larges = {n: f"{n}_{instead}" for n in (whole, part)}
        more = {alias: F.max(F.when(F.col(name) == n, F.col(instead))) for n, alias in larges.items()}
        a, b = (F.coalesce(F.col(larges[n]), F.col(n).cast("double")) for n in (whole, part))
        both = a.isNotNull() & b.isNotNull()
        apart = F.abs(a - b * float(ratio)) > F.greatest(a * float(relative), F.lit(float(absolute)))
        off = F.when(F.coalesce(*larges.values()).isNotNull(), apart).otherwise(off)
    return KeyCheck(
        f"ratio_{table}_{whole}_{part}", layer, table, "ratio", "consistency", limits,
        keys=(key,),
        per_key={
            whole: F.max(F.when(F.col(name) == whole, F.col(amount))),
            part: F.max(F.when(F.col(name) == part, F.col(amount))),
            **more,
        },
        rows=F.col(name).isin(whole, part), total=F.count_if(both), bad=both & off,
    )


def relationship(
    layer: str, table: str, key: str, parent: str, parent_key: str, null_is_orphan: bool = False
) -> Check:
    return ParentCheck(
        f"relationship_{table}_{key}", layer, table, "relationship", "consistency",
        key=key, parent=parent, parent_key=parent_key, null_is_orphan=null_is_orphan,
    )


# --- running them ------------------------------------------------------------


def evaluate(checks: Sequence[Check], tables: Tables) -> DataFrame:
    """One row per check: total, failures, percentage and verdict."""
    groups: dict[tuple, list[Check]] = {}
    for check in checks:
        groups.setdefault(check.shares, []).append(check)
    counts = []
    for group in groups.values():
        df, aggregates = group[0].counted_with(group, tables)
        counts.append(_counts(df, group, aggregates))
    return _with_verdicts(reduce(DataFrame.unionAll, counts), checks)


def _with_verdicts(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Join the counts with what is known of each check, and judge them."""
    labels = [
        (
            check.name, check.layer, check.kind, check.dimension, check.limits.severity,
            check.limits.warn_above, check.limits.error_above, check.limits.error_share,
        )
        for check in checks
    ]
    n_total, n_failed = F.col("n_total"), F.col("n_failed")
    # Exact: as a binary fraction a share such as 1 - 0.8 would move the limit.
    over_share = n_failed > n_total.cast("decimal(20,0)") * F.col("error_share")
    share = F.when(n_total > 0, F.round(n_failed * F.lit(100.0) / n_total, 3)).otherwise(0.0)
    verdict = (
        F.when(over_share | (n_failed > F.col("error_above")), "error")
        .when(n_failed > F.col("warn_above"), "warn")
        .otherwise("pass")
    )
    return (
        counts.join(in_plan_table(counts.sparkSession, labels, _LABELS), "check")
        .withColumns({"pct_failed": share, "verdict": verdict})
        .select(*RESULT_COLUMNS)
    )


def _per_key(table: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    return table.groupBy(*keys).agg(*[agg.alias(alias) for alias, agg in aggregates.items()])


def _counts(
    df: DataFrame, group: Sequence[Check], aggregates: Sequence[tuple[Column, Column]]
) -> DataFrame:
    """All counts of a group from one aggregation, as a row per check."""
    names = [f"{part}_{i}" for i in range(len(group)) for part in ("total", "failed")]
    columns = [column for pair in aggregates for column in pair]
    wide = df.agg(*[column.alias(name) for column, name in zip(columns, names, strict=True)])
    cells = ", ".join(
        f"'{check.name}', bigint(total_{i}), bigint(failed_{i})" for i, check in enumerate(group)
    )
    return wide.selectExpr(f"stack({len(group)}, {cells}) AS (check, n_total, n_failed)")


class GateFailed(RuntimeError):
    """At least one check ended in an error; nothing further may be built."""


def gate(results: Sequence) -> None:
    """Stop the run if any of the collected results is an error."""
    failed = [r for r in results if r.verdict == "error"]
    if failed:
        listed = ", ".join(f"{r.check} ({r.n_failed} of {r.n_total})" for r in failed)
        raise GateFailed(f"{len(failed)} of {len(results)} checks failed: {listed}")


def write_audit(
    checks: Sequence[Check], tables: Tables, results: Sequence, path_of: Callable[[str], str]
) -> dict[str, str]:
    """Keep the failing rows of every check that has any, whatever its severity; path by check.

    Checks that are counted in one pass are written in one, a folder for each: a row or key
    goes to the folder of every check it fails. Checks without failures cost no job.
    """
    failed = {r.check for r in results if r.n_failed > 0}
    groups: dict[tuple, list[Check]] = {}
    for check in checks:
        if check.name in failed:
            groups.setdefault(check.failing_shares, []).append(check)
    paths = {}
    for group in groups.values():
        if len(group) == 1:
            (check,) = group
            paths[check.name] = path_of(check.name)
            check.failing(tables).write.parquet(paths[check.name])
            continue
        path = path_of(f"{group[0].table}_{'_'.join(str(x) for x in _flat(group[0].failing_shares))}"[:120])
        failing_by_check(group, tables).write.partitionBy(FAILED_CHECK).parquet(path)
        paths |= {k.name: f"{path}/{FAILED_CHECK}={k.name}" for k in group}
    return paths


def failing_by_check(group: Sequence[Check], tables: Tables) -> DataFrame:
    """The failing rows of a group, once for each check they fail. Few fail, so the others are dropped first."""
    rows = group[0].failing_of(group, tables).where(any_bad(group))
    names = F.array_compact(F.array(*[F.when(k.bad, F.lit(k.name)) for k in group]))
    return rows.withColumn(FAILED_CHECK, F.explode(names))


def _flat(shares: tuple) -> list:
    return [x for part in shares for x in (part if isinstance(part, tuple) else (part,))]


def sample_failures(check: Check, tables: Tables, n: int = 10) -> DataFrame:
    """A few failing rows to look at."""
    return check.failing(tables).limit(n)
