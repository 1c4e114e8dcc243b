"""Declarative data checks: a DataFrame in, its violations out (empty = pass).

NULL handling follows the public definitions of the five test kinds:
``unique`` ignores NULL keys, ``accepted_values`` and ``expression_is_true``
pass on NULL results, ``not_null`` fails on them.  The failure count of a
check is the number of rows its violations query returns.

For a suite, :func:`model_check_counts` evaluates every check of one model
in a single scan and a single shuffle: the group-based checks (unique,
accepted values, unique combination) as grouping sets of one aggregation,
the row-level checks (not null, expression) as counts in its whole-table set.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED_VALUES = "accepted_values"
EXPRESSION_IS_TRUE = "expression_is_true"
UNIQUE_COMBINATION = "unique_combination_of_columns"
KINDS = [NOT_NULL, UNIQUE, ACCEPTED_VALUES, EXPRESSION_IS_TRUE, UNIQUE_COMBINATION]


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    columns: tuple[str, ...]
    # accepted values, or the expression text applied to the column
    arg: tuple[str, ...] | str | None = None

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{'_'.join(self.columns)}"

    def predicate_failing(self) -> Column:
        """Row-level failure predicate (not_null / expression_is_true only)."""
        c = self.columns[0]
        if self.kind == NOT_NULL:
            return F.col(c).isNull()
        if self.kind == EXPRESSION_IS_TRUE:
            # NOT (expr) is true: NULL results pass
            return F.coalesce(~F.expr(f"`{c}` {self.arg}"), F.lit(False))
        raise ValueError(f"{self.kind} is not a row-level check")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: list[str] | tuple[str, ...]) -> DataFrame:
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(~F.col(column).isin(*values))
    )


def expression_is_true(df: DataFrame, column: str, expression: str) -> DataFrame:
    return df.filter(F.coalesce(~F.expr(f"`{column}` {expression}"), F.lit(False)))


def unique_combination(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def violations(df: DataFrame, check: Check) -> DataFrame:
    c = check.columns
    if check.kind == NOT_NULL:
        return not_null(df, c[0])
    if check.kind == UNIQUE:
        return unique(df, c[0])
    if check.kind == ACCEPTED_VALUES:
        return accepted_values(df, c[0], check.arg)
    if check.kind == EXPRESSION_IS_TRUE:
        return expression_is_true(df, c[0], check.arg)
    if check.kind == UNIQUE_COMBINATION:
        return unique_combination(df, c)
    raise ValueError(check.kind)


def _summary_row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("test_name"),
        F.lit(check.model).alias("model"),
        F.lit(check.column_name).alias("column_name"),
        failures.cast("bigint").alias("failures"),
    )


def row_check_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks of one model in a single aggregate pass, one
    output row per check."""
    if not checks:
        raise ValueError("no checks")
    structs = [_summary_row(ch, F.count_if(ch.predicate_failing())) for ch in checks]
    return df.agg(F.array(*structs).alias("r")).select(F.inline("r"))


GROUP_KINDS = (UNIQUE, ACCEPTED_VALUES, UNIQUE_COMBINATION)


def model_check_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Every check of one model in one scan and one shuffle.

    The group-based checks need counts per value of their columns; one
    ``GROUPING SETS`` aggregation produces all of them at once (plus the
    whole-table set, which carries the row-level counts), and
    ``grouping_id()`` tells the sets apart.  A small second aggregate turns
    the groups into one failure count per check.
    """
    group_checks = [c for c in checks if c.kind in GROUP_KINDS]
    if not group_checks:
        return row_check_counts(df, checks)
    row_checks = [c for c in checks if c.kind not in GROUP_KINDS]
    sets: list[tuple[str, ...]] = list(dict.fromkeys(tuple(c.columns) for c in group_checks))
    cols = list(dict.fromkeys(col for s in sets for col in s))

    def gid(s: tuple[str, ...]) -> int:
        return sum(1 << (len(cols) - 1 - j) for j, col in enumerate(cols) if col not in s)

    aggs = [F.count(F.lit(1)).alias("_ck_n"), F.grouping_id().alias("_ck_gid")]
    aggs += [F.count_if(c.predicate_failing()).alias(f"_ck_r{i}") for i, c in enumerate(row_checks)]
    groups = df.groupingSets([list(s) for s in sets] + [[]], *cols).agg(*aggs)

    g, n = F.col("_ck_gid"), F.col("_ck_n")
    results = []
    for c in checks:
        if c.kind == UNIQUE:
            fail = F.count_if((g == gid(c.columns)) & F.col(c.columns[0]).isNotNull() & (n > 1))
        elif c.kind == ACCEPTED_VALUES:
            fail = F.count_if((g == gid(c.columns)) & ~F.col(c.columns[0]).isin(*c.arg))
        elif c.kind == UNIQUE_COMBINATION:
            fail = F.count_if((g == gid(c.columns)) & (n > 1))
        else:
            i = row_checks.index(c)
            fail = F.coalesce(F.sum(F.when(g == gid(()), F.col(f"_ck_r{i}"))), F.lit(0))
        results.append(_summary_row(c, fail))
    return groups.agg(F.array(*results).alias("r")).select(F.inline("r"))
