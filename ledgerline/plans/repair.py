"""Join repair: securities that arrive after their loans were joined.

What a late security can change is known beforehand: loans of its id in its month, and earlier unmatched loans of its
id, which are late from now on. Only these are joined again, only parts (months) in which a reason changed are
written again, and join counts get signed differences instead of a new count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import population
from . import release
from .parts import Parts, digests


def touched(loans: DataFrame, late: DataFrame) -> DataFrame:
    """``loans`` (with join_reason) plus ``touched``: whether the securities ``late`` can change the reason."""
    ids = late.where("security_id is not null").groupBy(F.col("security_id").alias("late_id")).agg(F.collect_set("report_period").alias("late_months"), F.max("report_period").alias("late_last"))
    # Loans without an id match nothing, so they need not meet in one task.
    deal = F.when(F.col("security_id").isNull(), 1 + F.pmod(F.xxhash64("loan_id", "report_period"), F.lit(population.SPREAD))).otherwise(0)
    met = loans.withColumn("deal", deal).join(ids.withColumn("none", F.pmod(F.xxhash64("late_id"), F.lit(1))), (F.col("deal") == F.col("none")) & (F.col("security_id") == F.col("late_id")), "left")
    hit = F.array_contains("late_months", F.col("report_period")) | ((F.col("join_reason") == "unmatched") & (F.col("late_last") > F.col("report_period")))
    return met.select(*loans.columns, F.coalesce(hit, F.lit(False)).alias("touched"))


def rejoined(loans: DataFrame, before: DataFrame, late: DataFrame) -> DataFrame:
    """``loans`` with the join_reason that all securities give, and the one they had as ``old_reason``.

    ``before`` and ``late``: security_id, report_period, security_status of the securities known before and new ones."""
    columns = ["security_id", "report_period", "security_status"]
    marked = touched(loans, late)
    ids = late.select("security_id").where("security_id is not null").distinct()
    known = before.join(ids, "security_id", "left_semi").select(*columns).unionByName(late.select(*columns))
    hit = marked.where("touched").drop("touched").withColumnRenamed("join_reason", "old_reason")
    again = population.join_reason(hit, known)
    rest = marked.where("not touched").drop("touched").withColumn("old_reason", F.col("join_reason"))
    return again.unionByName(rest.select(*again.columns))


def differences(changed: DataFrame) -> DataFrame:
    """report_period, join_reason, row_count: what changed reasons take from and add to join counts."""
    both = F.array(F.struct(F.col("old_reason").alias("join_reason"), F.lit(-1).cast("long").alias("n")), F.struct(F.col("join_reason").alias("join_reason"), F.lit(1).cast("long").alias("n")))
    each = changed.where("old_reason != join_reason").select("report_period", F.explode(both).alias("d"))
    return each.groupBy("report_period", "d.join_reason").agg(F.sum("d.n").alias("row_count")).where("row_count != 0")


def posted(counts: DataFrame, deltas: DataFrame) -> DataFrame:
    """Join counts after ``deltas``; reasons that no loan has left go."""
    columns = ["report_period", "join_reason", "row_count"]
    return counts.select(*columns).unionByName(deltas.select(*columns)).groupBy("report_period", "join_reason").agg(F.sum("row_count").alias("row_count")).where("row_count != 0")


@dataclass
class Repair:
    """Months that were written again, and loans whose reason changed."""

    months: list[str]
    changed: int


class JoinedLoans:
    """Joined loans and their join counts below ``root``, by month."""

    def __init__(self, spark, root: str, after=lambda step: None):
        self.spark, self.root = spark, root
        self.loans, self.counts = Parts(spark, f"{root}/loans", after), Parts(spark, f"{root}/join_counts", after)

    def publish(self, joined: DataFrame) -> None:
        """Writes joined loans (with report_period) and counts them."""
        staged = release.staged(joined.withColumn("part", F.col("report_period")), f"{self.root}/building")
        self.loans.commit(staged, digests(staged))
        self.recount()

    def uncounted(self) -> list[str]:
        """Months whose counts are not of the loans that are there: a repair ended between the two."""
        loans = self.loans.listed().select("part", "generation")
        counts = self.counts.listed().select("part", F.col("checksum").alias("generation"))
        return sorted(r.part for r in loans.join(counts, ["part", "generation"], "left_anti").collect())  # one row for each month

    def recount(self) -> list[str]:
        """Counts the months that lack it, from their loans."""
        months = self.uncounted()
        if months:
            rows = self.loans.read(months)
            self._count(rows.groupBy("report_period", "join_reason").agg(F.count("*").alias("row_count")), months)
        return months

    def _count(self, counts: DataFrame, months: list[str]) -> None:
        staged = release.staged(counts.withColumn("part", F.col("report_period")), f"{self.root}/building")
        of = self.loans.listed().where(F.col("part").isin(months)).select("part", F.col("generation").alias("checksum"))
        self.counts.commit(staged, of.join(digests(staged), "part", "left").select("part", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "digest", "checksum"))

    def repair(self, before: DataFrame, late: DataFrame) -> Repair:
        """After ``late`` securities arrived: ``before`` are those that the loans were joined with."""
        self.recount()
        last = late.agg(F.max("report_period")).first()[0]
        months = sorted(r.part for r in self.loans.listed().where(F.col("part") <= F.lit(last)).select("part").collect())
        loans = self.loans.read(months) if months else None
        if loans is None:
            return Repair([], 0)
        # First the few columns that say whose reason changes, then whole rows of the months where one does.
        narrow = loans.select("report_period", "loan_id", "security_id", "correction_indicator", "join_reason")
        deltas = release.staged(differences(rejoined(narrow, before, late)), f"{self.root}/building")
        changed = sorted(r.report_period for r in deltas.select("report_period").distinct().collect())
        if not changed:
            return Repair([], 0)
        rows = rejoined(self.loans.read(changed).drop("part"), before, late)
        staged = release.staged(rows.drop("old_reason").withColumn("part", F.col("report_period")), f"{self.root}/building")
        same = self.loans.listed().where(F.col("part").isin(changed)).select("part", "rows", "checksum")
        self.loans.commit(staged, same)
        self._count(posted(self.counts.read(changed), deltas), changed)
        n = deltas.where("row_count > 0").agg(F.sum("row_count")).first()[0]
        return Repair(changed, int(n))
