"""Independent checks of a cube: each returns the rows that break it, so a sound cube gives none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import CONTRACTS, KEY, VIEWS
from . import transitions
from .cube import COMPOSITIONS, is_active_loan, is_active_security

TOLERANCE = 1e-12


def contract_set(cube: DataFrame, contracts=CONTRACTS) -> DataFrame:
    """V1: contracts supported but absent, or present but not supported."""
    wanted = cube.sparkSession.createDataFrame([(c,) for c in contracts], "contract_id string")
    found = cube.select("contract_id").distinct()
    absent = wanted.join(found, "contract_id", "left_anti").withColumn("problem", F.lit("absent"))
    return absent.unionByName(found.join(wanted, "contract_id", "left_anti").withColumn("problem", F.lit("unsupported")))


def partition_bridge(partials: DataFrame, counts: DataFrame) -> DataFrame:
    """V2: files whose partial row count differs from their source's. ``counts``: source_file, report_period, rows."""
    p, c = partials.select("source_file", "report_period", F.col("rows").alias("partial_rows")), counts
    return p.join(c, ["source_file", "report_period"], "full").where("not (partial_rows <=> rows)")


def view_coverage(cube: DataFrame, periods: DataFrame) -> DataFrame:
    """V3: periods without the security population of both views."""
    have = cube.where("component = 'security_count' and contract_id = 'current_outstanding_balance_population'").select("report_period", "correction_view").distinct()
    need = periods.distinct().withColumn("correction_view", F.explode(F.array(*map(F.lit, VIEWS))))
    return need.join(have, ["report_period", "correction_view"], "left_anti")


def schema_coverage(cube: DataFrame, manifests: DataFrame) -> DataFrame:
    """V3: families and months of the manifests without a schema verdict or a transition flag."""
    need = manifests.select("report_period", F.col("source_family").alias("member")).distinct().withColumn("component", F.explode(F.array(F.lit("schema_pass"), F.lit("schema_transition_flag"))))
    have = cube.where("contract_id = 'schema_transition_status'").select("report_period", "member", "component").distinct()
    return need.join(have, ["report_period", "member", "component"], "left_anti")


def join_totals(counts: DataFrame, loans: DataFrame) -> DataFrame:
    """V18: months whose join reasons do not add up to their loans. ``counts``: report_period, join_reason, row_count."""
    total = counts.groupBy("report_period").agg(F.sum("row_count").alias("joined"))
    return total.join(loans.groupBy("report_period").agg(F.count("*").alias("accepted")), "report_period", "full").where("not (joined <=> accepted)")


def mix_reconciles(mix: DataFrame, months: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """V19: months whose product groups do not add up to the month, in count, balance or share.

    ``mix``: month, security_count, issuance, share; ``months``: month, security_count, issuance."""
    total = mix.groupBy("month").agg(F.sum("security_count").alias("n"), F.sum("issuance").alias("upb"), F.sum("share").alias("share"))
    return total.join(months, "month", "full").where(~F.coalesce((F.col("n") == F.col("security_count")) & (F.abs(F.col("upb") - F.col("issuance")) <= tolerance * F.greatest(F.lit(1.0), F.abs("issuance"))) & (F.abs(F.col("share") - 1) <= tolerance), F.lit(False)))


def segment_sums(cube: DataFrame) -> DataFrame:
    """V4, V5: segments whose numerators do not add up to their one denominator."""
    seg = cube.where((F.col("grain") == "loan-period") & (F.col("dimension") != "portfolio") & ~F.col("dimension").endswith("_summary") & F.col("denominator").isNotNull() & (F.col("component").endswith("_count") | F.col("component").endswith("_upb")) & (F.col("contract_id") != "delinquency_threshold_rates"))
    return seg.groupBy("contract_id", "component", "report_period", "dimension").agg(F.sum("numerator").alias("total"), F.min("denominator").alias("low"), F.max("denominator").alias("high")).where("total != low or low != high")


def summaries(cube: DataFrame) -> DataFrame:
    """V6: Top and Other rows that aren't two or don't add up."""
    basis = F.substring_index("component", "_", -1)
    rows = cube.where(F.col("dimension").endswith("_summary"))
    return rows.groupBy("report_period", "dimension", basis.alias("basis")).agg(F.count("*").alias("n"), F.sum("numerator").alias("total"), F.max("denominator").alias("denominator")).where("n != 2 or total != denominator")


def hhi_recomputed(cube: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """V7: concentrations that differ from the sum of squared shares of their members, or are missing."""
    members = cube.where(F.col("dimension").isin(*COMPOSITIONS) & F.col("contract_id").isin(*set(COMPOSITIONS.values())))
    share = F.col("numerator").cast("double") / F.sum(F.col("numerator").cast("double")).over(Window.partitionBy("report_period", "component"))
    again = members.withColumn("share", share).groupBy("report_period", F.concat("component", F.lit("_hhi")).alias("component")).agg(F.sum(F.col("share") * F.col("share")).alias("again"))
    own = cube.where("contract_id = 'hhi_concentration'").select("report_period", "component", "value")
    return again.join(own, ["report_period", "component"], "full").where(~F.coalesce(F.abs(F.col("again") - F.col("value")) <= tolerance, F.lit(False)))


def weighted_recomputed(cube: DataFrame) -> DataFrame:
    """V8: ratios that aren't their numerator over their denominator, scaled for rates and factors."""
    scale = F.when(F.col("contract_id") == "weighted_rates", 1000.0).when(F.col("contract_id") == "factor_level_change", 1e8).otherwise(1.0)
    again = F.when(F.col("denominator") > 0, F.col("numerator").cast("double") / F.col("denominator").cast("double") / scale)
    off = F.abs(again - F.col("value")) > TOLERANCE * F.greatest(F.lit(1.0), F.abs(again))
    return cube.where("contract_id != 'hhi_concentration'").where(off | (again.isNull() != F.col("value").isNull())).select(*KEY, "value", again.alias("again"))


def thresholds_recomputed(cube: DataFrame, loans: DataFrame) -> DataFrame:
    """V9: threshold rates that differ from a count over the loans, or periods without all six."""
    live = loans.where(is_active_loan() & F.col("days_delinquent").isNotNull())
    pairs = F.array(*(F.struct(F.lit(f"{d}_plus_{b}").alias("component"), F.when(F.col("days_delinquent") >= d, w).otherwise(0).cast("decimal(38,0)").alias("n"), w.cast("decimal(38,0)").alias("d")) for d in (30, 60, 90) for b, w in (("count", F.lit(1)), ("upb", F.col("current_upb_cents")))))
    again = live.select("report_period", F.explode(pairs).alias("p")).groupBy("report_period", "p.component").agg(F.sum("p.n").alias("again"), F.sum("p.d").alias("again_of"))
    own = cube.where("contract_id = 'delinquency_threshold_rates'").select("report_period", "component", "numerator", "denominator")
    return again.join(own, ["report_period", "component"], "full").where("not (again <=> numerator and again_of <=> denominator)")


def modification_recomputed(cube: DataFrame, loans: DataFrame) -> DataFrame:
    """V10: modification rates by count and balance that differ from the loans, or months that lack one."""
    modified = F.trim(F.coalesce("modification_program", F.lit(""))) != ""
    bases = F.array(*(F.struct(F.lit(f"modification_{b}_rate").alias("component"), w.cast("decimal(38,0)").alias("w")) for b, w in (("count", F.lit(1)), ("upb", F.col("current_upb_cents")))))
    live = loans.where(is_active_loan()).select("report_period", modified.alias("modified"), F.explode(bases).alias("b"))
    again = live.groupBy("report_period", "b.component").agg(F.coalesce(F.sum(F.when(F.col("modified"), F.col("b.w"))), F.lit(0)).cast("decimal(38,0)").alias("again"), F.sum("b.w").cast("decimal(38,0)").alias("of"))
    own = cube.where("contract_id = 'modification_rate'").select("report_period", "component", "numerator", "denominator")
    return again.join(own, ["report_period", "component"], "full").where("not (again <=> numerator and of <=> denominator)")


def removal_recomputed(cube: DataFrame, facts: DataFrame, view: str) -> DataFrame:
    """V11: removal shares by count and balance that differ from the facts, or lie at months without a month before.

    A share has no denominator where the month's removals, or for counts the month before's loans, are not all known."""
    live = is_active_security()
    known = lambda c: F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))
    by = facts.groupBy(S.month_index(F.col("report_period")).alias("month"), "report_period").agg(
        *(F.sum(known(f"involuntary_removal_{x}")).cast("decimal(38,0)").alias(f"removed_{b}") for b, x in (("count", "count"), ("upb", "upb_cents"))),
        *(F.count(F.when(F.col(f"involuntary_removal_{x}").isNull(), 1)).alias(f"missing_{b}") for b, x in (("count", "count"), ("upb", "upb_cents"))),
        F.sum(F.when(live, F.col("current_upb_cents")).otherwise(0)).cast("decimal(38,0)").alias("held_upb"), F.sum(F.when(live, known("loan_count")).otherwise(0)).cast("decimal(38,0)").alias("held_count"),
        F.count(F.when(live & F.col("loan_count").isNull(), 1)).alias("unknown_count"), F.lit(0).alias("unknown_upb"),
    )
    prior = by.select((F.col("month") + 1).alias("month"), *(F.col(f"{h}_{b}").alias(f"prior_{h}_{b}") for h in ("held", "unknown") for b in ("count", "upb")))
    both = by.join(prior, "month").select("report_period", F.explode(F.array(*(F.struct(F.lit(f"involuntary_removal_{b}_share").alias("component"), F.col(f"removed_{b}").alias("again"), F.when((F.col(f"missing_{b}") == 0) & (F.col(f"prior_unknown_{b}") == 0), F.col(f"prior_held_{b}")).alias("of")) for b in ("count", "upb")))).alias("r"))
    own = cube.where((F.col("contract_id") == "involuntary_removal_share") & (F.col("correction_view") == view)).select("report_period", "component", "numerator", "denominator")
    return both.select("report_period", "r.*").join(own, ["report_period", "component"], "full").where("not (again <=> numerator and of <=> denominator)")


def transition_sums(cube: DataFrame) -> DataFrame:
    """V12: origins whose destinations do not share one denominator and add up to it."""
    rows = cube.where("component in ('transition_count', 'transition_upb')").withColumn("origin", F.substring_index("member", " to ", 1))
    return rows.groupBy("report_period", "correction_view", "component", "origin").agg(F.sum("numerator").alias("total"), F.min("denominator").alias("low"), F.max("denominator").alias("high")).where("total != low or low != high")


def transition_coverage(cube: DataFrame, loans: DataFrame) -> DataFrame:
    """V12: months and views whose eligible origins are absent, or are not those that the loans' month before has."""
    live = F.array(*(F.when(F.col(v)["active"] & F.col(v)["days"].isNotNull(), F.lit(v)) for v in VIEWS))
    seen = transitions.histories(loans).select((F.col("month") + 1).alias("month"), F.explode(live).alias("correction_view")).where("correction_view is not null")
    again = seen.groupBy("month", "correction_view").agg(F.count("*").alias("again"))
    months = loans.select("report_period").distinct().select("report_period", S.month_index(F.col("report_period")).alias("month"))
    need = again.join(months, "month").drop("month")
    own = cube.where("contract_id = 'delinquency_roll_cure' and component = 'eligible_origin_count'").select("report_period", "correction_view", "numerator")
    return need.join(own, ["report_period", "correction_view"], "full").where("not (again <=> numerator)")


def new_delinquency_matches(cube: DataFrame) -> DataFrame:
    """V13: new delinquencies by count and balance that differ from the transitions out of Current."""
    rows = cube.where("component in ('transition_count', 'transition_upb') and member in ('Current to 30-59', 'Current to 60-89', 'Current to 90+')")
    basis = F.substring_index("component", "_", -1)
    again = rows.groupBy("report_period", "correction_view", basis.alias("basis")).agg(F.sum("numerator").alias("again"))
    own = cube.where("component in ('new_delinquency_count', 'new_delinquency_upb')").select("report_period", "correction_view", basis.alias("basis"), "numerator")
    return own.join(again, ["report_period", "correction_view", "basis"], "full").where("not (numerator <=> coalesce(again, 0))")


def cohort_sums(cube: DataFrame) -> DataFrame:
    """V14: cohorts whose seen and censored members are not all of them, by count or balance."""
    pick = lambda c, x: F.max(F.when(F.col("component").startswith(c), F.col(x)))
    rows = cube.where("dimension = 'redefault_trigger'").groupBy("report_period", "correction_view", "member", F.substring_index("component", "_", -1).alias("basis"))
    rows = rows.agg(pick("trigger_cohort_", "numerator").alias("total"), pick("redefault_", "denominator").alias("seen"), pick("right_censored_", "numerator").alias("cut"))
    return rows.where("not (total <=> seen + cut)")


def consolidation(whole: DataFrame, parts: DataFrame) -> DataFrame:
    """V15: rows in which one aggregation differs from the sum of partials, either way."""
    a, b = whole.select(*sorted(whole.columns)), parts.select(*sorted(whole.columns))
    return a.exceptAll(b).unionByName(b.exceptAll(a))


def unreleased(cube: DataFrame) -> DataFrame:
    """V16: rows that the catalog does not release, whatever their flag says, and rows flagged so."""
    approved = F.col("contract_id").isin(*CONTRACTS) & ((F.col("contract_id") != "rolling_issuance") | F.col("component").rlike("^rolling_(3|6|12)_(upb|count)$"))
    return cube.where(~F.col("released") | ~approved).select(*KEY)


def snapshot(cube: DataFrame) -> DataFrame:
    """V17: a fingerprint that does not depend on the order of rows."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*KEY, "numerator", "denominator", "observations")))
    return cube.agg(F.count("*").alias("rows"), F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("decimal(38,0)")).alias("fingerprint"))


def missing_known(cube: DataFrame) -> DataFrame:
    """Members that hide a missing value behind blank text."""
    return cube.where((F.trim("member") == "") | F.col("member").isNull()).select(*KEY)
