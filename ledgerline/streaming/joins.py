"""Loans that wait for their securities: the reasons of the batch join, on two unbounded inputs in any order.

A loan is told at once if its join doesn't depend on securities. Any other one waits until the watermark of both inputs
says that no security of its month, or of the months in which it would count as late, can still come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Tasks that the loans of one security are dealt to; what comes of its months, a row each, goes to all of them.
DEALS = 8


def month_start(period: Column) -> Column:
    """The first moment of a month (yyyy-MM) in UTC, whatever the session's time zone; null for other text."""
    return F.timestamp_seconds(F.unix_date(F.try_to_timestamp(F.concat(period, F.lit("-01")), F.lit("yyyy-MM-dd")).cast("date")).cast("long") * 86400)


def _timed(frame: DataFrame, delay: str) -> DataFrame:
    return frame.withColumn("at", month_start(F.col("report_period"))).where("at is not null").withWatermark("at", delay)


def _gone() -> Column:
    return F.coalesce(F.col("correction_indicator") == "D", F.lit(False))


def _told(loan: DataFrame) -> DataFrame:
    """The loans whose join doesn't depend on securities, with its reason."""
    return loan.where(_gone() | F.col("security_id").isNull()).withColumn("join_reason", F.when(_gone(), "terminated").otherwise("ineligible"))


def _waiting(loan: DataFrame) -> DataFrame:
    return loan.where(~_gone() & F.col("security_id").isNotNull())


def _verdicts(waiting: DataFrame, securities: DataFrame, delay: str, wait: int) -> DataFrame:
    """at, security_id, report_period, join_reason and row_count, once for each id and month that ``waiting`` loans name.

    Ids and months meet the securities' months, not the loans: however many months an id has, a loan's row is read once."""
    ended = F.max(F.coalesce(F.col("security_status").isin("P", "C", "D"), F.lit(False)).cast("int"))
    index = _timed(securities.where("security_id is not null").select("security_id", "report_period", "security_status"), delay)
    index = index.groupBy("at", "security_id").agg(F.count("*").alias("matches"), ended.alias("ended"), F.min(S.month_index(F.col("report_period"))).alias("of_month"))
    index = index.select(F.col("at").alias("of_at"), F.col("security_id").alias("of"), "of_month", "matches", "ended")
    asked = waiting.groupBy("at", "security_id", "report_period").agg(F.count("*").alias("row_count"))
    # Days bound the state; months decide.
    near = (F.col("of_at") >= F.col("at")) & (F.col("of_at") <= F.col("at") + F.expr(f"interval {31 * wait} days"))
    pairs = asked.join(index, (F.col("security_id") == F.col("of")) & near, "leftOuter")
    same, later = F.col("of_at") == F.col("at"), (F.col("of_at") > F.col("at")) & (F.col("of_month") - S.month_index(F.col("report_period")) <= wait)
    facts = {"n": F.when(same, F.col("matches")), "ended": F.when(same, F.col("ended")), "later": later.cast("int")}
    found = pairs.groupBy("at", "security_id", "report_period").agg(F.max("row_count").alias("row_count"), *(F.coalesce(F.max(c), F.lit(0)).alias(n) for n, c in facts.items()))
    reason = F.when(F.col("ended") == 1, "terminated").when(F.col("n") > 1, "ambiguous").when(F.col("n") == 1, "matched").when(F.col("later") == 1, "late").otherwise("unmatched")
    return found.select("at", "security_id", "report_period", reason.alias("join_reason"), "row_count")


def join_reasons(loans: DataFrame, securities: DataFrame, delay: str = "62 days", wait: int = 12, deals: int = DEALS) -> DataFrame:
    """``loans`` plus ``join_reason``, as ``population.join_reason`` gives it, where a security counts as late if it comes
    within ``wait`` months after the loan's.

    Equal rows come as often as they came. Rows whose month is no month are left out, as no watermark reaches them, and so
    are those that come after their month was told; those more than ``delay`` late may be. State: a loan for
    ``wait`` months, a security's month likewise; it goes as the watermark passes. On bounded inputs this is a plain query."""
    loan = _timed(loans, delay)
    waiting = _waiting(loan)
    verdicts = _verdicts(waiting, securities, delay, wait).select(F.col("at").alias("of_at"), F.col("security_id").alias("of"), F.col("report_period").alias("of_period"), "join_reason", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("of_deal"))
    dealt = waiting.withColumn("deal", F.pmod(F.xxhash64(*loans.columns), F.lit(deals)).cast("int"))
    own = (F.col("at") == F.col("of_at")) & (F.col("security_id") == F.col("of")) & (F.col("report_period") == F.col("of_period")) & (F.col("deal") == F.col("of_deal"))
    return dealt.join(verdicts, own).select(*loans.columns, "join_reason").unionByName(_told(loan).drop("at"))


def reason_counts(loans: DataFrame, securities: DataFrame, delay: str = "62 days", wait: int = 12) -> DataFrame:
    """report_period, join_reason and row_count of the loans of ``join_reasons``, to be added up; counted as they come, so that
    none waits itself: state are ids and months."""
    loan = _timed(loans.select("security_id", "report_period", "correction_indicator"), delay)
    told = _told(loan).groupBy("at", "report_period", "join_reason").agg(F.count("*").alias("row_count"))
    columns = ["report_period", "join_reason", "row_count"]
    return _verdicts(_waiting(loan), securities, delay, wait).select(*columns).unionByName(told.select(*columns))
