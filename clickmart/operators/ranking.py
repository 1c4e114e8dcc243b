"""Global ``ROW_NUMBER`` / ``NTILE`` / ``RANK`` without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.  Here all orders
of a table are sorted together, in one range shuffle of narrow rows:

1. One row per order and input row holds the order's number and its sort columns (those of
   other orders stay NULL).  The union is range-partitioned and sorted by all of them.  With a
   unique tie-break as last column no run of equal keys is too large to cut.
2. The sorted rows are written once to the shared folder with their partition and place in it;
   per partition and order the rows are counted (at most as many counts as partitions and
   orders), and the running sum of the counts is the place of a partition's first row.
3. ``NTILE(k)``: only the first rows of the tiles are read, k - 1 per order.  A row's tile is
   the number of those that don't sort after it: a comparison with constants, no join.
   ``RANK``: step 1 runs over the distinct key values with their counts, the sums give each
   value its rank, and the ranks are joined to the rows by value, values with many rows by a
   broadcast (there are few of them).

Every table takes the same path.  Callers materialise an input that is costly to derive.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# a value with more than one row in HOT_SHARE is joined by a broadcast: at most HOT_SHARE values
HOT_SHARE = 1000


@dataclass(frozen=True)
class SortKey:
    """One ``ORDER BY`` item with PostgreSQL defaults: ASC sorts NULLs last,
    DESC sorts NULLs first."""

    column: str | Column
    desc: bool = False
    nulls_first: bool | None = None

    def value(self) -> Column:
        return F.col(self.column) if isinstance(self.column, str) else self.column

    @property
    def nulls_go_first(self) -> bool:
        return self.desc if self.nulls_first is None else self.nulls_first

    def sort(self, value: Column | None = None) -> Column:
        v = self.value() if value is None else value
        if self.desc:
            return v.desc_nulls_first() if self.nulls_go_first else v.desc_nulls_last()
        return v.asc_nulls_first() if self.nulls_go_first else v.asc_nulls_last()

    def after(self, value: Column, mark: Column) -> Column:
        """Whether ``value`` sorts strictly after ``mark`` (never NULL)."""
        beyond = F.coalesce(value < mark if self.desc else value > mark, F.lit(False))
        by_null = mark.isNull() & value.isNotNull() if self.nulls_go_first else mark.isNotNull() & value.isNull()
        return beyond | by_null


def asc(c: str | Column, nulls_first: bool | None = None) -> SortKey:
    return SortKey(c, False, nulls_first)


def desc(c: str | Column, nulls_first: bool | None = None) -> SortKey:
    return SortKey(c, True, nulls_first)


def idiv(a: Column, b: Column) -> Column:
    """Exact integral division of non-negative BIGINTs (SQL ``a DIV b``)."""
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def _partitions(df: DataFrame, partitions: int | None) -> int:
    return int(partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sorted(rows: DataFrame, order: list[Column], partitions: int | None) -> DataFrame:
    """``rows`` in a global order, written once, with ``_rk_part`` and ``_rk_at`` (place in it)."""
    dealt = rows.repartitionByRange(_partitions(rows, partitions), *order).sortWithinPartitions(*order)
    # the lower 33 bits of this id count the rows of a partition
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialise(dealt.select("*", F.spark_partition_id().alias("_rk_part"), at.alias("_rk_at")), "ranked")


def _before(rows: DataFrame, group: list[str], size: Column) -> DataFrame:
    """Per partition (and ``group``): ``_rk_before``, the sizes of the earlier ones, and ``_rk_total``."""
    parts = rows.groupBy(*group, "_rk_part").agg(F.sum(size).alias("_rk_n"), F.min("_rk_at").alias("_rk_first"))
    own = Window.partitionBy(*(group or [F.lit(0)]))
    earlier = own.orderBy("_rk_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*group, "_rk_part", "_rk_first", F.coalesce(F.sum("_rk_n").over(earlier), F.lit(0)).alias("_rk_before"), F.sum("_rk_n").over(own).alias("_rk_total"))


def _all_orders(frames: list[DataFrame], orders: list[list[SortKey]], extra: list[str]) -> tuple[DataFrame, list[Column]]:
    """The sort columns of all orders in one frame, ``_rk_o`` the order's number, and the common order."""
    types = [dict(df.select(*[k.value().alias(f"_rk_{o}_{i}") for i, k in enumerate(keys)]).dtypes) for o, (df, keys) in enumerate(zip(frames, orders, strict=True))]
    parts = []
    for o, (df, keys) in enumerate(zip(frames, orders, strict=True)):
        own = {f"_rk_{o}_{i}": k.value() for i, k in enumerate(keys)}
        columns = [own.get(c, F.lit(None).cast(t)).alias(c) for by in types for c, t in by.items()]
        parts.append(df.select(F.lit(o).alias("_rk_o"), *columns, *extra))
    common = [F.col("_rk_o").asc()] + [k.sort(F.col(f"_rk_{o}_{i}")) for o, keys in enumerate(orders) for i, k in enumerate(keys)]
    return reduce(DataFrame.unionByName, parts), common


def global_row_number(df: DataFrame, order: list[SortKey], name: str = "row_number", partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)`` (1-based, BIGINT).  ``order`` must
    make every row unique (add a key column as the last tie-break)."""
    rows = _sorted(df, [k.sort() for k in order], partitions)
    before = F.broadcast(_before(rows, [], F.lit(1)).select("_rk_part", "_rk_before"))
    number = (F.col("_rk_before") + F.col("_rk_at") + 1).cast("bigint")
    return rows.join(before, "_rk_part").select(*df.columns, number.alias(name))


def _tile_starts(n: int, k: int) -> list[int]:
    """0-based places of the first rows of the tiles 2 to ``k`` that hold rows."""
    q, r = divmod(n, k)
    return [t * q + min(t, r) for t in range(1, k) if t * q + min(t, r) < n]


def _reached(keys: list[SortKey], marks: list[Column]) -> Column:
    """Whether a row's tuple sorts at or after the marks."""
    out = F.lit(True)
    for key, mark in reversed(list(zip(keys, marks, strict=True))):
        out = key.after(key.value(), mark) | (key.value().eqNullSafe(mark) & out)
    return out


def with_ntiles(df: DataFrame, specs: list[tuple[str, int, list[SortKey]]], partitions: int | None = None) -> DataFrame:
    """Append several ``NTILE`` columns (BIGINT), ``specs`` = [(name, k, order), ...]; each
    order must make every row unique.

    The tiles' first rows (k - 1 per order) come to the driver as constants.
    """
    orders = [order for _, _, order in specs]
    narrow, common = _all_orders([df] * len(specs), orders, [])
    rows = _sorted(narrow, common, partitions)
    # as many counts as partitions and orders; they say in which partition a place lies
    counts = rows.groupBy("_rk_o", "_rk_part").agg(F.count(F.lit(1)).alias("n"), F.min("_rk_at").alias("first"))
    parts: dict[int, list] = {o: [] for o in range(len(specs))}
    for row in sorted(counts.collect()):
        parts[row["_rk_o"]].append(row)
    wanted = []
    for o, (_, k, _) in enumerate(specs):
        starts = _tile_starts(sum(row["n"] for row in parts[o]), k)
        before = 0
        for row in parts[o]:
            wanted += [(o, row["_rk_part"], row["first"] + at - before) for at in starts if before <= at < before + row["n"]]
            before += row["n"]
    starts = {o: [] for o in range(len(specs))}
    if wanted:
        one_of = [(F.col("_rk_o") == o) & (F.col("_rk_part") == part) & (F.col("_rk_at") == at) for o, part, at in wanted]
        for row in rows.filter(reduce(Column.__or__, one_of)).collect():
            starts[row["_rk_o"]].append(row)
    types = dict(narrow.dtypes)
    tiles = []
    for o, (name, _, order) in enumerate(specs):
        marks = [[F.lit(row[f"_rk_{o}_{i}"]).cast(types[f"_rk_{o}_{i}"]) for i in range(len(order))] for row in starts[o]]
        tile = reduce(Column.__add__, [_reached(order, m).cast("bigint") for m in marks], F.lit(1).cast("bigint"))
        tiles.append(tile.alias(name))
    return df.select("*", *tiles)


def global_ntile(df: DataFrame, k: int, order: list[SortKey], name: str = "ntile", partitions: int | None = None) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order)`` (BIGINT); ``order`` must be unique."""
    return with_ntiles(df, [(name, k, order)], partitions)


def with_ranks(df: DataFrame, specs: list[tuple[str, list[SortKey]]], partitions: int | None = None) -> DataFrame:
    """Append several ``RANK`` columns (BIGINT, gaps after ties), ``specs`` = [(name, order), ...]."""
    orders, frames = [], []
    for o, (_, order) in enumerate(specs):
        own = [f"_rk_{o}_{i}" for i in range(len(order))]
        frames.append(df.select(*[k.value().alias(c) for k, c in zip(order, own, strict=True)]).groupBy(*own).agg(F.count(F.lit(1)).alias("_rk_size")))
        orders.append([SortKey(c, k.desc, k.nulls_go_first) for k, c in zip(order, own, strict=True)])
    values, common = _all_orders(frames, orders, ["_rk_size"])
    rows = _sorted(values, common, partitions)
    before = _before(rows, ["_rk_o"], F.col("_rk_size"))
    inside = Window.partitionBy("_rk_o", "_rk_part").orderBy("_rk_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_rk_size").over(inside), F.lit(0))
    ranked = rows.withColumn("_rk_inside", inside).join(F.broadcast(before), ["_rk_o", "_rk_part"])
    ranked = materialise(ranked.withColumn("_rk_rank", (F.col("_rk_before") + F.col("_rk_inside") + 1).cast("bigint")), "ranked-values")
    for o, (name, order) in enumerate(specs):
        own = [f"_rk_{o}_{i}" for i in range(len(order))]
        of = ranked.filter(F.col("_rk_o") == o).select(*own, F.col("_rk_rank").alias(name), (F.col("_rk_size") * HOT_SHARE > F.col("_rk_total")).alias("_rk_hot"))
        df = _by_value(df, order, own, of, name)
    return df


def _by_value(df: DataFrame, order: list[SortKey], own: list[str], ranked: DataFrame, name: str) -> DataFrame:
    """``df`` with the ranks of its values, read once.

    Rows with a hot value get their rank by a broadcast; for the join of the others they are
    spread over numbers that no value has, so they fill no task.
    """
    same = [k.value().eqNullSafe(F.col(c)) for k, c in zip(order, own, strict=True)]
    columns = df.columns
    hot = ranked.filter("_rk_hot").select(*own, F.col(name).alias("_rk_known"))
    rest = ranked.filter(~F.col("_rk_hot")).select(*own, name, F.lit(0).alias("_rk_spread"))
    out = df.join(F.broadcast(hot), reduce(Column.__and__, same), "left").select(*columns, "_rk_known")
    number = F.pmod(F.xxhash64(*columns), F.lit(HOT_SHARE)).cast("int") + 1
    out = out.withColumn("_rk_to", F.when(F.col("_rk_known").isNull(), F.lit(0)).otherwise(number))
    out = out.join(rest, reduce(Column.__and__, same, F.col("_rk_to") == F.col("_rk_spread")), "left")
    return out.select(*columns, F.coalesce("_rk_known", name).alias(name))


def global_rank(df: DataFrame, order: list[SortKey], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``RANK() OVER (ORDER BY order)`` (BIGINT, gaps after ties)."""
    return with_ranks(df, [(name, order)], partitions)
