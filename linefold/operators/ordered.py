"""Operators over rows that have an order within a group: gaps, runs, carried state, look-ahead, as-of.

Each names its grouping and ordering columns; none orders a whole table in one
task.  A group is a file, document, user or the like, never the whole input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.functions.text import upper_median
from linefold.session import written


def order(group: list[str], by: list) -> Window:
    return Window.partitionBy(*group).orderBy(*by)


def numbered(df: DataFrame, group: list[str], by: list, name: str = "idx") -> DataFrame:
    return df.withColumn(name, F.row_number().over(order(group, by)).cast("long"))


def numbered_wide(df: DataFrame, group: list[str], by: list, name: str = "idx") -> DataFrame:
    """As ``numbered``, for groups of any size: no task holds more of a group than a range of it.

    Rows are dealt by ranges of (group, order) and numbered within each range;
    the sizes of a group's earlier ranges are added.  The dealt rows are a
    table, so that both passes see the same ranges.  Rows that are equal in
    group and order are dealt too, by their place in the input.
    """
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *group, *by, "_tie").withColumn("_range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    key = [*group, "_range"]
    sizes = dealt.groupBy(*key).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(order(group, ["_range"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*[F.col(k).alias(f"_of_{k}") for k in key], before.alias("_before"))
    place = dealt.withColumn("_place", F.row_number().over(order(key, [*by, "_tie"])))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key])
    return place.join(sizes, same).select(*df.columns, (F.col("_before") + F.col("_place")).alias(name))


def keep_first(df: DataFrame, key: list[str], by: list, when: Column | None = None) -> DataFrame:
    """One row per key, the first by ``by``; rows for which ``when`` is false are all kept."""
    rn = F.row_number().over(order(key, by))
    df = df.withColumn("_rn", rn)
    return df.where((F.col("_rn") == 1) | (~when if when is not None else F.lit(False))).drop("_rn")


def gap_to_previous(value: Column, group: list[str], by: list) -> Column:
    return value - F.lag(value).over(order(group, by))


def learned_gap(df: DataFrame, group: list[str], gap: str, low: float, high: float, factor: float, least: float) -> DataFrame:
    """Per group: max(least, factor x upper median of the gaps within [low, high])."""
    usable = df.where(F.col(gap).between(low, high))
    return usable.groupBy(*group).agg(F.greatest(F.lit(float(least)), upper_median(gap).cast("double") * factor).alias("threshold"))


def run_id(starts: Column, group: list[str], by: list) -> Column:
    """Number of starts so far: rows of a run share it."""
    return F.sum(F.coalesce(starts, F.lit(False)).cast("long")).over(order(group, by).rowsBetween(Window.unboundedPreceding, 0))


def carried(value: Column, group: list[str], by: list, back: int | None = None, current: bool = True) -> Column:
    """The last non-null value so far, at most ``back`` rows before."""
    w = order(group, by).rowsBetween(Window.unboundedPreceding if back is None else -back, 0 if current else -1)
    return F.last(value, ignorenulls=True).over(w)


def ahead_text(text: Column, rows: int, group: list[str], by: list, sep: str = "") -> Column:
    """The text of this row and the next ``rows - 1``, joined."""
    return F.array_join(F.collect_list(text).over(order(group, by).rowsBetween(0, rows - 1)), sep)


def any_near(flag: Column, before: int, after: int, group: list[str], by: list) -> Column:
    w = order(group, by).rowsBetween(-before, after)
    return F.coalesce(F.max(F.coalesce(flag, F.lit(False)).cast("int")).over(w), F.lit(0)) == 1


def asof(left: DataFrame, right: DataFrame, group: list[str], left_at: str, right_at: str, value: str, strict: bool = False, out: str | None = None) -> DataFrame:
    """Append to each left row the value of the latest right row of its group at or before it (before it, if ``strict``).

    A union and one window, so its cost is that of a sort by group; of right
    rows at the same place the greatest value counts.
    """
    out = out or value
    names = left.columns
    side = F.lit(0 if strict else 1)
    a = left.select(*[F.col(g) for g in group], F.col(left_at).alias("_at"), side.alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.struct(*names).alias("_row"))
    b = right.select(*[F.col(g) for g in group], F.col(right_at).alias("_at"), (1 - side).alias("_side"), F.col(value).alias("_v"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"))
    w = order(group, ["_at", "_side", F.col("_v").asc_nulls_first()]).rowsBetween(Window.unboundedPreceding, 0)
    # left rows at one place come after (before, if strict) all right rows at it
    joined = a.unionByName(b).withColumn(out + "_", F.last("_v", ignorenulls=True).over(w))
    return joined.where("_row is not null").select("_row.*", F.col(out + "_").alias(out))


def islands(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Maximal runs of consecutive integers: group, first, last, n."""
    d = df.select(*group, value).distinct()
    d = d.withColumn("_k", F.col(value) - F.row_number().over(order(group, [value])))
    return d.groupBy(*group, "_k").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("n")).drop("_k")


def missing_between(df: DataFrame, group: list[str], value: str, most: int = 12) -> DataFrame:
    """Per group the first ``most`` integers absent between its smallest and largest value, from neighbours' differences."""
    d = df.select(*group, value).distinct().withColumn("_next", F.lead(value).over(order(group, [value])))
    gone = d.where(F.col("_next") - F.col(value) > 1).withColumn("missing", F.explode(F.sequence(F.col(value) + 1, F.least(F.col("_next") - 1, F.col(value) + most))))
    rn = F.row_number().over(order(group, ["missing"]))
    return gone.select(*group, F.col("missing")).withColumn("_rn", rn).where(F.col("_rn") <= most).drop("_rn")
