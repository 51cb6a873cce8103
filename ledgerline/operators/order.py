"""Exact order statistics of groups of any size, by refinement.

A group's values between its least and largest are counted in ``BINS`` bins of equal width; the bin that holds a rank is
narrowed to its own least and largest value and counted again, until few rows are left or all are equal. Only these
are ordered. Bins are counted in every task before anything moves, so no task sees a group, and no buffer holds its
values; each round reads the rows once for all groups and ranks. Groups of at most ``FEW`` rows are ordered at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024
FEW = 10_000
#: Rows of the ranks sought that are broadcast.
BROADCAST = 100_000


def nearest(p: float) -> Callable[[Column], tuple[Column, Column, Column]]:
    """The value at the nearest rank from above, as ``percentile_disc`` gives it: ranks from 1, and the share of the upper one."""
    return lambda n: (F.greatest(F.ceil(p * n), F.lit(1)).cast("long"),) * 2 + (F.lit(0.0),)


def between(p: float) -> Callable[[Column], tuple[Column, Column, Column]]:
    """Between the two nearest values, as ``percentile`` and ``median`` give it."""

    def of(n: Column) -> tuple[Column, Column, Column]:
        at = F.lit(p) * (n - 1)
        return (F.floor(at) + 1).cast("long"), (F.ceil(at) + 1).cast("long"), at - F.floor(at)

    return of


def _met(rows: DataFrame, sought: DataFrame, by: list[str]) -> DataFrame:
    """Rows with the ranks sought in their group, values outside the narrowed ranges left out."""
    s = F.broadcast(sought) if sought.limit(BROADCAST + 1).count() <= BROADCAST else sought
    same = F.lit(True)
    for i, _ in enumerate(by):
        same = same & F.col(f"b{i}").eqNullSafe(F.col(f"s{i}"))
    return rows.join(s, same & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))


def order_statistics(rows: DataFrame, by: list[str], value: str, wanted: dict[str, Callable[[Column], tuple[Column, Column, Column]]], folder: str) -> DataFrame:
    """``by`` and one column for each of ``wanted`` (``nearest`` or ``between``), nulls of ``value`` apart; groups without any
    value are left out. ``folder``: where rounds are kept; their rows are groups times ranks."""
    from ..plans.release import staged

    keys = [f"s{i}" for i in range(len(by))]
    v = rows.where(F.col(value).isNotNull()).select(*(F.col(c).alias(f"b{i}") for i, c in enumerate(by)), F.col(value).alias("v"))
    groups = v.groupBy(*(F.col(f"b{i}").alias(k) for i, k in enumerate(keys))).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    groups = staged(groups, folder)
    ranks = []
    for spec in wanted.values():
        low, high, _ = spec(F.col("n"))
        ranks += [low, high]
    sought = groups.select(*keys, "n", "lo", "hi", F.explode(F.array_distinct(F.array(*ranks))).alias("rank")).withColumn("within", F.col("rank"))
    found: list[DataFrame] = []
    kept = [*keys, "rank"]
    number = lambda c: F.col(c).cast("double")
    while True:
        sought = staged(sought, folder)
        found.append(sought.where("lo = hi").select(*kept, F.col("lo").alias("v")))
        open_ = sought.where("lo != hi")
        few = (F.col("n") <= FEW) | (number("lo") == number("hi"))
        last, more = open_.where(few), open_.where(~few)
        counted = _met(v, last, by).groupBy(*kept, "within", "v").agg(F.count("*").alias("times"))
        upto = F.sum("times").over(Window.partitionBy(*kept).orderBy("v"))
        found.append(staged(counted.withColumn("upto", upto).where("within between upto - times + 1 and upto").select(*kept, "v"), folder))
        if more.isEmpty():
            break
        # Monotone in the value, roundings included: equal values share a bin, and bins are in the values' order.
        place = F.least(F.floor((number("v") - number("lo")) / (number("hi") - number("lo")) * BINS), F.lit(BINS - 1)).cast("int")
        bins = _met(v, more, by).groupBy(*kept, "within", place.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy(*kept).orderBy("bin"))
        sought = bins.withColumn("upto", upto).where("within between upto - n + 1 and upto").select(*keys, "n", "lo", "hi", "rank", (F.col("within") - F.col("upto") + F.col("n")).alias("within"))
    all_ = found[0]
    for f in found[1:]:
        all_ = all_.unionByName(f)
    values = all_.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))  # two ranks for each of wanted
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"g{i}"))
    out = groups.select(*(F.col(k).alias(f"g{i}") for i, k in enumerate(keys)), "n").join(values, same)
    columns = []
    for name, spec in wanted.items():
        low, high, share = spec(F.col("n"))
        a, b = F.element_at("at", low), F.element_at("at", high)
        exact = spec.__qualname__.startswith("nearest")
        columns.append((a if exact else a.cast("double") + share * (b.cast("double") - a.cast("double"))).alias(name))
    return out.select(*(F.col(f"g{i}").alias(c) for i, c in enumerate(by)), *columns)
