"""Month-to-month transitions of loans, and cohorts after a cure or a modification, without a loop over months.

Loans are shuffled once, by loan. There each month's first and last version become the states of both views, windows
over a loan's months give what precedes and follows each state, and what happened is summed by month in each task
before the one small shuffle that all metrics are derived from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as C
from ..functions import scalars as S
from .cube import is_active_loan, row, tall

KEY = ("source_family", "loan_id", "security_id")
#: What transitions and cohorts read of a loan.
NEEDED = (*KEY, "report_period", "as_of_timestamp", "publication_date", "source_file", "source_row", "join_reason", "correction_indicator", "current_upb_cents", "days_delinquent", "modification_program")
THRESHOLD, WINDOW = 30, 12
TRIGGERS = ("cure", "modification")


#: Texts that order versions, and how many different ones (days and files) are put in order on the driver.
ORDERED, FEW = ("as_of_timestamp", "publication_date", "source_file"), 50_000


def numbered(loans: DataFrame) -> DataFrame | None:
    """``loans`` with ``rank``, a number that orders them as as_of_timestamp, publication_date, source_file and source_row
    do, nulls first; None if there are more than ``FEW`` days and files, or rows are not numbers."""
    if dict(loans.dtypes)["source_row"] not in ("tinyint", "smallint", "int", "bigint"):
        return None
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ORDERED))).alias("r")
    found = loans.select(each).select("r.*").distinct().limit(FEW + 1).collect()
    if len(found) > FEW:
        return None
    high, out = F.lit(0).cast("long"), loans
    for c in ORDERED:
        values = sorted((r.value for r in found if r.name == c and r.value is not None), key=str.encode)  # as Spark orders texts
        places = loans.sparkSession.createDataFrame([(v, i + 1) for i, v in enumerate(values)], f"`of_{c}` string, `at_{c}` long")
        out = out.join(F.broadcast(places), F.col(c) == F.col(f"of_{c}"), "left")
        high = high * (FEW + 1) + F.coalesce(f"at_{c}", F.lit(0))
    # Rows are longs: moved above zero, where null is. The whole stays below 10**33.
    low = F.coalesce(F.col("source_row").cast("decimal(20,0)") + F.expr("9223372036854775809BD"), F.expr("0BD"))
    return out.withColumn("rank", (high.cast("decimal(18,0)") * F.expr("20000000000000000000BD") + low).cast("decimal(38,0)"))


def histories(loans: DataFrame, to_store: bool = False, whole: bool = False) -> DataFrame:
    """One row for each loan and month: KEY, report_period, month, and the states of the version that ranks first
    (``original``) and last (``latest``): structs of active, upb, days, modified.

    ``to_store``: no window follows before they are written, so versions meet in each task before the shuffle. ``whole``:
    of many months, so versions are numbered first if that can be (``numbered``, which reads the loans once), and hashed."""
    key = [F.coalesce(F.col(c), F.lit("")).alias(c) if c == "security_id" else F.col(c) for c in KEY]
    fields = {"active": is_active_loan(), "upb": F.coalesce("current_upb_cents", F.lit(0)), "days": F.col("days_delinquent"), "modified": F.trim(F.coalesce("modification_program", F.lit(""))) != ""}
    state = F.struct(*(c.alias(n) for n, c in fields.items()))
    ranked = numbered(loans) if to_store and whole else None
    if ranked is not None:
        # Everything that is aggregated has a fixed width, so versions are hashed in each task; structs and texts would be sorted.
        rows = ranked.select(*key, "report_period", "rank", *(c.alias(f"own_{n}") for n, c in fields.items()))
        views = {"original": F.min_by, "latest": F.max_by}
        out = rows.groupBy(*KEY, "report_period").agg(*(f(f"own_{n}", "rank").alias(f"{v}_{n}") for v, f in views.items() for n in fields))
        out = out.select(*KEY, "report_period", *(F.struct(*(F.col(f"{v}_{n}").alias(n) for n in fields)).alias(v) for v in views))
        return out.withColumn("month", S.month_index(F.col("report_period")))
    rank = F.struct("as_of_timestamp", "publication_date", "source_file", "source_row")
    dealt = loans.select(*key, "report_period", rank.alias("rank"), state.alias("state"))
    dealt = dealt if to_store else dealt.repartition(*KEY)
    out = dealt.groupBy(*KEY, "report_period").agg(F.min_by("state", "rank").alias("original"), F.max_by("state", "rank").alias("latest"))
    return out.withColumn("month", S.month_index(F.col("report_period")))


def history(loans: DataFrame, view: str) -> DataFrame:
    """One row for each loan and month of one view: KEY, report_period, month, active, upb, days, modified."""
    return histories(loans).select(*KEY, "report_period", "month", f"{view}.*")


def followed(states: DataFrame, views: tuple[str, ...], threshold: int = THRESHOLD, window: int = WINDOW, upto: int | None = None) -> DataFrame:
    """``states`` (with a state struct for each of ``views``) plus, for each view, ``next_``, ``last_`` (the states of the
    months just after and before, or null) and ``status_``: what a cohort that starts here comes to.

    A cohort at month s looks at months s+1..s+window: with f the first that is distressed, it redefaults if all
    months before f are there and eligible; it completes if there is no f and all are there and eligible. With ``upto``,
    the last month of all loans, a cohort that only this end cuts short is open."""
    months = Window.partitionBy(*KEY).orderBy("month")
    near = [F.lead("month").over(months).alias("after"), F.lag("month").over(months).alias("before")]
    near += [f(v).over(months).alias(f"{n}_{v}") for v in views for n, f in (("next", F.lead), ("last", F.lag))]
    out = states.select("*", *near)
    first = lambda c: F.min(F.when(c, F.col("month"))).over(months.rangeBetween(1, window))
    eligible = {v: F.col(v)["active"] & F.col(v)["days"].isNotNull() for v in views}
    last = F.coalesce(F.col("after") != F.col("month") + 1, F.lit(True))  # a month without a next one
    ahead = [F.min(F.when(last, F.col("month"))).over(months.rangeBetween(0, window - 1)).alias("gap")]
    ahead += [first(e & (F.col(v)["days"] >= threshold)).alias(f"bad_{v}") for v, e in eligible.items()]
    ahead += [first(~e).alias(f"unfit_{v}") for v, e in eligible.items()]
    out = out.select("*", *ahead)
    whole = lambda c: F.coalesce(c, F.lit(True))
    columns = []
    for v in views:
        gap, bad, unfit = F.col("gap"), F.col(f"bad_{v}"), F.col(f"unfit_{v}")
        status = F.when(bad.isNotNull() & whole(gap >= bad) & whole(unfit > bad), "redefault").when(F.coalesce(bad, gap, unfit).isNull(), "complete")
        status = status.otherwise("censored") if upto is None else status.when(F.coalesce(bad, unfit).isNull() & (gap == upto), "open").otherwise("censored")
        columns += [F.when(F.col("after") == F.col("month") + 1, F.col(f"next_{v}")).alias(f"next_{v}"), F.when(F.col("before") == F.col("month") - 1, F.col(f"last_{v}")).alias(f"last_{v}"), status.alias(f"status_{v}")]
    return out.select(*states.columns, *columns)


def triggers(view: str, threshold: int = THRESHOLD) -> dict[str, Column]:
    """Conditions under which a cohort starts, on a row of ``followed``."""
    now, last = F.col(view), F.col(f"last_{view}")
    both = now["active"] & F.coalesce(last["active"], F.lit(False))
    return {"cure": both & (last["days"] >= threshold) & (now["days"] == 0), "modification": both & ~last["modified"] & now["modified"]}


def cohorts(states: DataFrame, threshold: int = THRESHOLD, window: int = WINDOW) -> DataFrame:
    """Each trigger of one view's states with its outcome: redefault, complete or censored (open cohorts included)."""
    one = states.select(*KEY, "report_period", "month", F.struct("active", "upb", "days", "modified").alias("s"))
    kinds = F.array(*(F.when(c, F.lit(k)) for k, c in triggers("s", threshold).items()))
    out = followed(one, ("s",), threshold, window).select(*KEY, "report_period", "s.upb", F.col("status_s").alias("status"), F.explode(kinds).alias("trigger"))
    return out.where("trigger is not null").select(*KEY, "report_period", "trigger", "upb", "status")


def _period(month: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor((month - 1) / 12).cast("int"), ((month - 1) % 12 + 1).cast("int"))


def happenings(loans: DataFrame, views: tuple[str, ...] = C.VIEWS, threshold: int = THRESHOLD, window: int = WINDOW, upto: int | None = None, states: DataFrame | None = None) -> DataFrame:
    """correction_view, kind, report_period, origin, result, n, upb: for transitions the bands before and after, at the
    month after; for triggers the outcome, at the month where the cohort starts. Months without any loan are left out.
    ``states``: the ``histories`` of the loans, if they are stored already."""
    states = histories(loans) if states is None else states
    rows = []
    for v in views:
        now, later = F.col(v), F.col(f"next_{v}")
        gone = later["active"].isNull() | ~later["active"] | later["days"].isNull()
        result = F.when(gone, "Attrition").otherwise(S.delinquency_band(later["days"]))
        happened = [("transition", now["active"] & now["days"].isNotNull(), F.col("month") + 1, S.delinquency_band(now["days"]), result)]
        happened += [(k, c, F.col("month"), F.lit(""), F.col(f"status_{v}")) for k, c in triggers(v, threshold).items()]
        rows += [F.when(c, F.struct(F.lit(v).alias("correction_view"), F.lit(k).alias("kind"), m.alias("month"), o.alias("origin"), r.alias("result"), now["upb"].alias("upb"))) for k, c, m, o, r in happened]
    each = followed(states, views, threshold, window, upto).select(F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("r")).select("r.*")
    out = each.groupBy(F.col("correction_view").alias("view"), F.col("kind").alias("what"), "month", "origin", "result").agg(F.count("*").alias("n"), F.sum(S.wide(F.col("upb"))).alias("upb"), F.max("kind").alias("kind"), F.max("correction_view").alias("correction_view"))
    # View and kind are aggregates, so that what selects or joins by them does not sink below the exchange, which all parts then share.
    out = out.withColumn("report_period", _period(F.col("month"))).drop("month", "what", "view")
    return out.join(F.broadcast(loans.select("report_period").distinct()), "report_period", "left_semi")  # one row for each month


def roll_cure(counts: DataFrame) -> DataFrame:
    """``counts``: the transitions of ``happenings``."""
    origin = Window.partitionBy("correction_view", "report_period", "origin")
    wide = counts.withColumn("all_n", F.sum("n").over(origin)).withColumn("all_upb", F.sum("upb").over(origin))
    member = F.concat("origin", F.lit(" to "), "result")
    rows = [row("delinquency_roll_cure", f"transition_{b}", v, t, "n", "delinquency_transition", member) for b, v, t in (("count", "n", "all_n"), ("upb", "upb", "all_upb"))]
    eligible = counts.groupBy("correction_view", "report_period").agg(F.sum(F.when(F.col("upb").isNotNull(), F.col("n"))).alias("n"))  # names upb, so that it reads the same exchange
    return tall(wide, rows, F.col("correction_view"), "loan-cohort").unionByName(tall(eligible, [row("delinquency_roll_cure", "eligible_origin_count", "n", None, "n")], F.col("correction_view"), "loan-cohort"))


def new_delinquency(counts: DataFrame) -> DataFrame:
    """From Current into 30 days or more, among all that were Current; zero rows included."""
    current, late = F.col("origin") == "Current", F.col("result").isin("30-59", "60-89", "90+")
    total = lambda c, x: F.coalesce(F.sum(F.when(c, S.wide(F.col(x)))), F.lit(0).cast(C.WIDE))
    wide = counts.groupBy("correction_view", "report_period").agg(*(total(current, x).alias(f"from_{x}") for x in ("n", "upb")), *(total(current & late, x).alias(f"late_{x}") for x in ("n", "upb")))
    rows = [row("new_delinquency_redefault", f"new_delinquency_{b}", f"late_{x}", f"from_{x}", "from_n", "delinquency_transition", "Current to 30+") for b, x in (("count", "n"), ("upb", "upb"))]
    return tall(wide, rows, F.col("correction_view"), "loan-cohort")


def cohort_rows(outcomes: DataFrame, periods: DataFrame, views: tuple[str, ...] = C.VIEWS) -> DataFrame:
    """Six rows for every period, view and trigger, zeros included. ``outcomes``: the triggers of ``happenings``."""
    spine = periods.select("report_period").distinct().select("report_period", F.explode(F.array(*map(F.lit, views))).alias("correction_view")).select("*", F.explode(F.array(*map(F.lit, TRIGGERS))).alias("kind"))
    of = lambda *s: F.col("result").isin(*s)
    total = lambda c, x: F.coalesce(F.sum(F.when(c, S.wide(F.col(x)))), F.lit(0).cast(C.WIDE))
    groups = {"all": of("redefault", "complete", "censored"), "bad": of("redefault"), "seen": of("redefault", "complete"), "cut": of("censored")}
    sums = outcomes.groupBy("report_period", "correction_view", "kind").agg(*(total(c, x).alias(f"{k}_{x}") for k, c in groups.items() for x in ("n", "upb")))
    wide = spine.join(sums, ["report_period", "correction_view", "kind"], "left")
    rows = []
    for b, x in (("count", "n"), ("upb", "upb")):
        z = lambda k, x=x: F.coalesce(F.col(f"{k}_{x}"), F.lit(0).cast(C.WIDE))
        dims = {"dimension": "redefault_trigger", "member": F.col("kind")}
        rows += [
            row("new_delinquency_redefault", f"trigger_cohort_{b}", z("all"), None, z("all", "n").cast("long"), **dims),
            row("new_delinquency_redefault", f"redefault_{b}", z("bad"), z("seen"), z("seen", "n").cast("long"), **dims),
            row("new_delinquency_redefault", f"right_censored_{b}", z("cut"), z("all"), z("all", "n").cast("long"), **dims),
        ]
    return tall(wide, rows, F.col("correction_view"), "loan-cohort")


def transition_cube(loans: DataFrame, only=None) -> DataFrame:
    """Both views of both contracts; all parts share the one aggregation of ``happenings``."""
    happened = happenings(loans)
    counts = happened.where("kind = 'transition'")
    out = []
    if only is None or "delinquency_roll_cure" in only:
        out.append(roll_cure(counts))
    if only is None or "new_delinquency_redefault" in only:
        out += [new_delinquency(counts), cohort_rows(happened.where("kind != 'transition'"), loans)]
    first, *rest = out
    for f in rest:
        first = first.unionByName(f)
    return first
