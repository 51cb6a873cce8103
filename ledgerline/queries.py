"""Queries of the engine over the test tables, each with SQL that says the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas as C
from .functions import scalars as S
from .operators import fields, leaks, order, population
from .plans import bindings, conformance, cube, cube_sql, incremental, parts, release, repair, transitions, verify
from .sources import archives
from .streaming import cohorts, joins
from .streaming import events as streams

Query = Callable[[SparkSession, str], DataFrame]


def as_text(frame: DataFrame) -> DataFrame:
    """A cube for comparison: exact sums as text, values to ten places."""
    return frame.select(*C.KEY, F.col("numerator").cast("string").alias("numerator"), F.col("denominator").cast("string").alias("denominator"), "observations", F.round("value", 10).alias("value"))


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark, sf_dir) -> dict[str, DataFrame]:
    facts = bindings.securities(spark, sf_dir)
    return {v: population.version_view(facts, ["report_period", "security_id"], v) for v in C.VIEWS}


def manifests(spark, sf_dir) -> DataFrame:
    facts = bindings.securities(spark, sf_dir)
    n = F.col("source_id") % 60
    disposed = facts.withColumn("disposition", F.when(n == 0, "rejected").when(n == 30, "duplicate").when(n == 1, "excluded").otherwise("accepted"))
    versions = facts.groupBy("report_period", "source_family").agg(F.min("schema_version").alias("schema_version"))
    return population.manifest(disposed, ["report_period", "source_family"]).join(versions, ["report_period", "source_family"])


LOAN_CONTRACTS = (
    "current_outstanding_balance_population", "loan_balance_distribution", "correction_restatement_volume", "deferred_upb_share", "weighted_age_maturity", "weighted_rates", "ltv_metrics", "dti_metric",
    "credit_score_model_metrics", "delinquency_distribution", "state_composition", "counterparty_composition", "modification_volume", "guarantee_mi_share", "first_time_homebuyer_share",
    "loan_property_composition", "assistance_resolution_share", "green_social_eligibility",
)
SECURITY_CONTRACTS = (
    "security_size_distribution", "current_outstanding_balance_population", "correction_restatement_volume", "weighted_rates", "ltv_metrics", "dti_metric", "credit_score_model_metrics", "green_social_eligibility", "mission_metrics",
    "factor_level_change", "involuntary_removal_volume", "involuntary_removal_share",
)
ISSUANCE_CONTRACTS = ("issuance_volume", "security_size_distribution", "issuance_product_mix", "period_change", "rolling_issuance")
TRUST_CONTRACTS = ("source_population_accounting", "source_disposition_rates", "schema_transition_status")
DERIVED = {"hhi_concentration": (cube.hhi, ("state_composition", "counterparty_composition")), "delinquency_threshold_rates": (cube.threshold_rates, ("delinquency_distribution",)), "modification_rate": (cube.modification_rate, ("current_outstanding_balance_population", "modification_volume"))}


def loan_passes(contracts: tuple[str, ...] | None) -> int:
    """Reads of the loans that the given contracts need: totals, segments, tops, each derived contract, transitions (states, months)."""
    wants = lambda *names: contracts is None or bool(set(contracts) & set(names))
    sums = {c for c, _, _ in cube.LOAN_WEIGHTED.values()} | {"current_outstanding_balance_population", "loan_balance_distribution", "correction_restatement_volume", "deferred_upb_share"}
    # Tops share the exchange of segments that are compositions alone.
    reads = [wants(*sums), wants(*(c for c in LOAN_CONTRACTS if c not in sums or c == "credit_score_model_metrics")), wants(*cube.COMPOSITIONS.values()) and wants(*(c for c in LOAN_CONTRACTS if c not in cube.COMPOSITIONS.values()))]
    return sum(reads) + sum(wants(d) for d in DERIVED) + 2 * wants("delinquency_roll_cure", "new_delinquency_redefault")


def metric(spark: SparkSession, sf_dir: str, contracts: tuple[str, ...] | None = None) -> DataFrame:
    """Cube rows of the given contracts (all by default), from as few scans as they need."""
    wants = lambda *names: contracts is None or set(contracts) & set(names)
    passes = loan_passes(contracts)
    loans = bindings.kept_loans(spark, sf_dir, _folder(spark, "loans")) if passes > 1 else bindings.loans(spark, sf_dir)
    frames = []
    if wants(*LOAN_CONTRACTS):
        frames.append(cube.loan_cube(loans, contracts))
    if wants(*SECURITY_CONTRACTS):
        frames += [cube.security_cube(f, v, contracts) for v, f in views(spark, sf_dir).items()]
    if wants(*ISSUANCE_CONTRACTS):
        frames.append(cube.issuance(bindings.securities(spark, sf_dir), bindings.product_group(), contracts))
    if wants(*TRUST_CONTRACTS):
        frames.append(cube.trust(manifests(spark, sf_dir), contracts, issued(spark, sf_dir)))
    for name, (derive, needs) in DERIVED.items():
        if wants(name):
            frames.append(derive(cube.loan_base(loans, needs)))
    if wants("new_issuance_share_ending_book"):
        book = cube.security_cube(views(spark, sf_dir)["latest"], "latest", ("current_outstanding_balance_population",))
        frames.append(cube.issuance_share(cube.union([cube.issuance(bindings.securities(spark, sf_dir), bindings.product_group(), ("issuance_volume",)), book])))
    if wants("delinquency_roll_cure", "new_delinquency_redefault"):
        frames.append(transitions.transition_cube(loans, contracts))
    if wants("join_coverage"):
        frames.append(cube.join_coverage(joined(spark, sf_dir).groupBy("join_reason").agg(F.count("*").alias("row_count"))))
    if wants("file_completeness"):
        frames.append(cube.file_completeness(completeness(spark, sf_dir)))
    return cube.union(frames)


# ---- operators


def joined(spark, sf_dir) -> DataFrame:
    """Loans against all securities under the ids that joins use, so that every reason occurs."""
    securities = bindings.securities(spark, sf_dir).drop("security_id").withColumnRenamed("join_security_id", "security_id")
    return population.join_reason(bindings.loans(spark, sf_dir).drop("join_reason"), securities)


JOINED_SQL = (
    f"WITH {bindings.SECURITY_CTE}, {bindings.LOAN_CTE}, kept AS (SELECT * EXCLUDE (security_id, join_security_id), join_security_id AS security_id FROM sec), "
    "j AS (SELECT loan.*, (SELECT count(*) FROM kept k WHERE k.report_period = loan.report_period AND k.security_id = loan.security_id) AS n, "
    "(SELECT count(*) FROM kept k WHERE k.report_period = loan.report_period AND k.security_id = loan.security_id AND k.security_status IN ('P', 'C', 'D')) AS ended, "
    "(SELECT max(report_period) FROM kept k WHERE k.security_id = loan.security_id) AS last FROM loan), "
    "jr AS (SELECT report_period, CASE WHEN correction_indicator = 'D' OR ended > 0 THEN 'terminated' WHEN security_id IS NULL THEN 'ineligible' WHEN n > 1 THEN 'ambiguous' WHEN n = 1 THEN 'matched' WHEN last > report_period THEN 'late' ELSE 'unmatched' END AS join_reason FROM j)"
)

WINDOWS = (("pools", "v1", "1995-01", "1998-05"), ("pools", "v2", "1998-06", "2002-03"), ("supers", "v1", "1994-11", "1998-05"), ("supers", "v3", "1998-06", "2001-12"))


def windows(spark) -> DataFrame:
    return spark.createDataFrame(list(WINDOWS), "family string, schema_version string, period_min string, period_max string")


def completeness(spark, sf_dir) -> DataFrame:
    return population.completeness(windows(spark), received(spark, sf_dir))


def received(spark, sf_dir) -> DataFrame:
    """Families and months of which a package has come."""
    return bindings.securities(spark, sf_dir).select(F.col("package_family").alias("family"), F.col("package_period").alias("report_period")).distinct()


_WINDOW_VALUES = "(VALUES " + ", ".join(f"('{f}', '{v}', '{a}', '{b}')" for f, v, a, b in WINDOWS) + ") AS w(family, schema_version, period_min, period_max)"
COMPLETENESS_SQL = (
    f"WITH {bindings.SECURITY_CTE}, e AS (SELECT DISTINCT family, strftime(m, '%Y-%m') AS report_period FROM (SELECT family, unnest(generate_series(CAST(period_min || '-01' AS TIMESTAMP), CAST(period_max || '-01' AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM {_WINDOW_VALUES})), "
    "g AS (SELECT DISTINCT package_family AS family, package_period AS report_period FROM sec), "
    "x AS (SELECT e.family, e.report_period, CASE WHEN g.family IS NULL THEN 0 ELSE 1 END AS n FROM e LEFT JOIN g USING (family, report_period))"
)


def disposed(spark, sf_dir) -> DataFrame:
    return population.dispositions(bindings.issuance(spark, sf_dir), ["report_month", "security_id"], [F.col("source_file"), F.col("source_row")])


def issued(spark, sf_dir) -> DataFrame:
    """Manifests of the issuance files, one for each month."""
    return population.manifest(disposed(spark, sf_dir), ["source_file"]).withColumn("report_period", F.substring("source_file", 4, 7))


DISPOSED_SQL = (
    f"WITH {bindings.ISSUANCE_CTE}, a AS (SELECT *, CASE WHEN issuance_upb IS NULL AND current_upb IS NULL AND security_factor IS NULL AND security_status = 'C' THEN 'excluded' END AS x, "
    "CASE WHEN issuance_upb IS NULL AND current_upb IS NULL AND security_factor IS NULL AND security_status = 'C' THEN 'status-C security without balances' "
    "WHEN issuance_upb IS NULL OR current_upb IS NULL OR security_factor IS NULL THEN 'issuance UPB, current UPB, and security factor are required together' "
    "WHEN NOT regexp_matches(trim(report_month), '^20[0-9]{2}-(0[1-9]|1[0-2])$') THEN 'report_month must be YYYY-MM' WHEN trim(security_id) = '' THEN 'security identifier is required' WHEN trim(security_type) = '' THEN 'security type is required' "
    "WHEN least(issuance_upb, current_upb, cpr_pct, published_files, expected_files, publication_lag_days) < 0 THEN 'numeric measures cannot be negative' WHEN issuance_upb <= 0 OR current_upb > issuance_upb THEN 'balances violate issuance/current UPB constraints' "
    "WHEN NOT (security_factor > 0 AND security_factor <= 1) THEN 'security factor must be greater than 0 and at most 1' WHEN cpr_pct > 100 THEN 'CPR percent cannot exceed 100' WHEN published_files > expected_files THEN 'published file count cannot exceed expected file count' END AS why FROM iss), "
    "b AS (SELECT *, coalesce(x, CASE WHEN why IS NULL THEN 'valid' ELSE 'rejected' END) AS d FROM a), "
    "c AS (SELECT *, row_number() OVER (PARTITION BY report_month, security_id, d ORDER BY source_file, source_row) AS k FROM b), "
    "dis AS (SELECT *, CASE WHEN d <> 'valid' THEN d WHEN k > 1 THEN 'duplicate' ELSE 'accepted' END AS disposition, CASE WHEN d = 'valid' AND k > 1 THEN 'duplicate key' ELSE why END AS reason FROM c)"
)

MANIFEST_SQL = (
    "SELECT *, rejected_count + duplicate_count AS quarantined_count, CASE WHEN rejected_count + duplicate_count > 0 THEN 'fail' ELSE 'pass' END AS quality_status, CASE WHEN rejected_count + duplicate_count > 0 THEN 0 ELSE accepted_count END AS published_count FROM "
    "(SELECT source_file, count(*) AS input_count, " + ", ".join(f"count(CASE WHEN disposition = '{d}' THEN 1 END) AS {d}_count" for d in ("accepted", "excluded", "rejected", "duplicate")) + " FROM dis GROUP BY 1)"
)

RULES = {
    "code": {"target": "code", "type": "enum", "valid_values": ["A", "N"], "nullable": False, "sentinels": [("R", "not_available")]},
    "amount": {"target": "amount", "type": "decimal", "scale": 1, "max_length": 8, "range": {"min": 1000, "max": 90000, "out_of_range_action": "not_available"}},
    "size": {"target": "size", "type": "integer", "range": {"min": 1, "max": 6}, "null_tokens": ["", "5"]},
    "ship": {"target": "ship", "type": "date", "raw_format": "MMDDCCYY", "fixed_day": "01"},
    "class": {"target": "class", "type": "text", "row_classes": ["standard"], "indicators": ["N", "C"]},
}


def field_rules(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    row_class = F.when(F.col("l_suppkey") % 7 == 0, "modified").otherwise("standard")
    indicator = F.when(F.col("l_partkey") % 50 == 0, "D").otherwise("N")
    raw = {"code": F.col("l_returnflag"), "amount": F.col("l_extendedprice").cast("decimal(20,2)").cast("string"), "size": F.col("l_linenumber").cast("string"), "ship": F.date_format("l_shipdate", "MMddyyyy"), "class": F.when(F.col("l_suppkey") % 3 == 0, "").otherwise(F.col("l_linestatus"))}
    checked = {n: fields.validated(RULES[n], raw[n], row_class, indicator if n == "class" else None) for n in RULES}
    out = lines.select(*(c.alias(n) for n, c in checked.items()))
    errors = F.concat_ws("; ", *(F.col(n)["error"] for n in RULES))
    return out.select(fields.packed([F.col(n) for n in RULES]).alias("statuses"), errors.alias("errors")).groupBy("statuses", "errors").agg(F.count("*").alias("rows"))


FIELD_RULES_SQL = """
WITH a AS (SELECT l_returnflag AS code, CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS VARCHAR) AS amount, CAST(l_linenumber AS VARCHAR) AS size, strftime(l_shipdate, '%m%d%Y') AS ship,
  CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE l_linestatus END AS cls, l_suppkey % 7 = 0 AS modified, l_partkey % 50 = 0 AS deleted FROM lineitem),
b AS (SELECT CASE WHEN code = 'R' THEN 'N' WHEN code IN ('A', 'N') THEN 'V' ELSE '?' END AS s1, CASE WHEN code NOT IN ('R', 'A', 'N') THEN 'code has an unknown code' END AS e1,
  CASE WHEN length(amount) > 8 THEN '?' WHEN length(split_part(amount, '.', 2)) > 1 THEN '?' ELSE 'V' END AS s2, CASE WHEN length(amount) > 8 THEN 'amount exceeds max length' WHEN length(split_part(amount, '.', 2)) > 1 THEN 'amount exceeds approved scale' END AS e2,
  CASE WHEN size = '5' THEN '0' WHEN CAST(size AS INT) BETWEEN 1 AND 6 THEN 'V' ELSE '?' END AS s3, CASE WHEN size <> '5' AND CAST(size AS INT) NOT BETWEEN 1 AND 6 THEN 'size is outside its approved range' END AS e3,
  CASE WHEN substr(ship, 3, 2) = '01' THEN 'V' ELSE '?' END AS s4, CASE WHEN substr(ship, 3, 2) <> '01' THEN 'ship has an invalid provider-defaulted day' END AS e4,
  CASE WHEN deleted THEN '?' WHEN modified AND cls <> '' THEN '?' WHEN modified THEN 'A' WHEN cls = '' THEN '0' ELSE 'V' END AS s5,
  CASE WHEN deleted THEN 'class has invalid correction context' WHEN modified AND cls <> '' THEN 'class is populated outside its applicable row class' END AS e5 FROM a)
SELECT s1 || s2 || s3 || s4 || s5 AS statuses, concat_ws('; ', e1, e2, e3, e4, e5) AS errors, count(*) AS rows FROM b GROUP BY 1, 2
"""


def parsing(spark, sf_dir) -> DataFrame:
    """Scaled decimals, integers, dates, flags and names of odd raw texts."""
    raw = table(spark, sf_dir, "orders").select(F.col("o_orderkey"), F.expr("case o_orderkey % 8 when 0 then '-' when 1 then '.' when 2 then concat('-', cast(o_orderkey as string), '.5') when 3 then ' .25 ' when 4 then '1.234' when 5 then '' when 6 then '+3' else cast(o_orderkey as string) end").alias("raw"), F.date_format("o_orderdate", "MMyyyy").alias("mmccyy"))
    return raw.select(
        "o_orderkey", S.parse_scaled(F.col("raw"), 2).alias("cents"), S.is_scaled(F.col("raw"), 2).alias("valid"), S.parse_integer(F.col("raw")).alias("number"),
        S.parse_factor_date(F.col("mmccyy")).alias("factor_period"), S.publication_date(F.concat(F.lit("fu"), F.substring("mmccyy", 5, 2), F.substring("mmccyy", 1, 2), F.lit("15.txt"))).alias("published"),
        S.parse_flag(F.element_at(F.array(*map(F.lit, ["TRUE", " y ", "no", "", "maybe"])), (F.col("o_orderkey") % 5 + 1).cast("int"))).alias("flag"),
    )


PARSING_SQL = """
WITH a AS (SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN '-' WHEN 1 THEN '.' WHEN 2 THEN concat('-', CAST(o_orderkey AS VARCHAR), '.5') WHEN 3 THEN ' .25 ' WHEN 4 THEN '1.234' WHEN 5 THEN '' WHEN 6 THEN '+3' ELSE CAST(o_orderkey AS VARCHAR) END AS raw, strftime(o_orderdate, '%m%Y') AS f FROM orders)
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN -(o_orderkey * 100 + 50) WHEN 3 THEN 25 WHEN 7 THEN o_orderkey * 100 END AS cents, o_orderkey % 8 NOT IN (4, 6) AS valid,
  CASE o_orderkey % 8 WHEN 6 THEN 3 WHEN 7 THEN o_orderkey END AS number, CASE WHEN regexp_matches(f, '^(0[1-9]|1[0-2])20') THEN substr(f, 3, 4) || '-' || substr(f, 1, 2) END AS factor_period,
  '20' || substr(f, 5, 2) || '-' || substr(f, 1, 2) || '-15' AS published, CAST(CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 0 END AS INT) AS flag FROM a
"""


def _versions(view: str, as_of: str | None = None) -> Query:
    def run(spark, sf_dir):
        out = population.version_view(bindings.securities(spark, sf_dir), ["report_period", "security_id"], view, as_of)
        return out.select("report_period", "security_id", "source_id", "as_of_timestamp", "current_upb_cents")

    return run


def _versions_sql(view: str, as_of: str | None = None) -> str:
    d = "" if view == "original" else " DESC"
    cut = f" AND as_of_timestamp <= '{as_of}'" if as_of else ""
    return f"WITH {bindings.SECURITY_CTE} SELECT report_period, security_id, source_id, as_of_timestamp, current_upb_cents FROM (SELECT *, row_number() OVER (PARTITION BY report_period, security_id ORDER BY as_of_timestamp{d}, publication_date{d}, source_id{d}) AS k FROM sec WHERE quality_status = 'pass'{cut}) WHERE k = 1"


def lineage(spark, sf_dir) -> DataFrame:
    facts = bindings.securities(spark, sf_dir)
    facts = facts.withColumn("record_hash", S.record_hash(*(F.col(c) for c in ("prefix", "security_status", "correction_indicator"))))
    return population.lineage(facts, ["report_period", "security_id"])


LINEAGE_SQL = f"""
WITH {bindings.SECURITY_CTE}, a AS (SELECT *, prefix || chr(31) || security_status || chr(31) || correction_indicator AS h FROM sec),
b AS (SELECT report_period, security_id, lag(source_id) OVER w AS prior_source_id, source_id AS replacement_source_id, lag(h) OVER w <> h AS changed FROM a WINDOW w AS (PARTITION BY report_period, security_id ORDER BY as_of_timestamp, source_id))
SELECT * FROM b WHERE prior_source_id IS NOT NULL
"""


def duplicates(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    kept, counts = population.duplicates(lines, ["l_orderkey", "l_linenumber"], [F.col(c) for c in lines.columns])
    totals = kept.groupBy("l_returnflag").agg(F.count("*").alias("accepted"), F.round(F.sum(F.col("l_extendedprice").cast("decimal(20,2)")).cast("double"), 2).alias("price"))
    return totals.crossJoin(counts.agg(F.sum("duplicates").alias("duplicates")))  # one row on the right


DUPLICATES_SQL = """
WITH a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS k FROM lineitem)
SELECT l_returnflag, count(*) AS accepted, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS DOUBLE), 2) AS price, (SELECT CAST(count(*) AS BIGINT) FROM a WHERE k > 1) AS duplicates FROM a WHERE k = 1 GROUP BY 1
"""


def schema_match(spark, sf_dir) -> DataFrame:
    files = bindings.securities(spark, sf_dir).select(F.col("source_family").alias("family"), "report_period").distinct()
    return population.schema_version(files, windows(spark))


SCHEMA_MATCH_SQL = f"WITH {bindings.SECURITY_CTE}, f AS (SELECT DISTINCT source_family AS family, report_period FROM sec) SELECT f.family, f.report_period, count(w.schema_version) AS fits, min(w.schema_version) AS schema_version FROM f LEFT JOIN {_WINDOW_VALUES} ON w.family = f.family AND f.report_period BETWEEN w.period_min AND w.period_max GROUP BY 1, 2"


def provenance(spark, sf_dir) -> DataFrame:
    facts = bindings.securities(spark, sf_dir)
    evidence = facts.groupBy("report_period").agg(F.sum("issuance_cents").alias("upb"))
    sources = facts.select("report_period", "source_family", "schema_version").distinct()
    out = population.provenance(evidence, sources, ["report_period"])
    return out.select("report_period", "upb", F.concat_ws(",", F.transform("sources", lambda s: F.concat_ws(":", s["source_family"], s["schema_version"]))).alias("sources"))


PROVENANCE_SQL = f"WITH {bindings.SECURITY_CTE}, d AS (SELECT DISTINCT report_period, source_family, schema_version FROM sec), s AS (SELECT report_period, string_agg(source_family || ':' || schema_version, ',' ORDER BY source_family, schema_version) AS sources FROM d GROUP BY 1) SELECT report_period, CAST(u AS BIGINT) AS upb, sources FROM (SELECT report_period, sum(issuance_cents) AS u FROM sec GROUP BY 1) JOIN s USING (report_period)"


def mix(spark, sf_dir) -> DataFrame:
    """Month by product group with its share, largest first."""
    facts = bindings.securities(spark, sf_dir)
    by = facts.groupBy(F.col("report_period").alias("month"), bindings.product_group().alias("product_group")).agg(F.count("*").alias("security_count"), F.sum("issuance_cents").alias("issuance_cents"))
    share = S.safe_ratio(F.col("issuance_cents"), F.sum("issuance_cents").over(Window.partitionBy("month")))
    return by.withColumn("issuance_share", F.round(share, 10)).orderBy("month", F.col("issuance_cents").desc(), "product_group")


MIX_SQL = f"WITH {bindings.SECURITY_CTE}, g AS (SELECT report_period AS month, {bindings.PRODUCT_GROUP_SQL} AS product_group, count(*) AS security_count, CAST(sum(issuance_cents) AS BIGINT) AS issuance_cents FROM sec GROUP BY 1, 2) SELECT *, round(CAST(issuance_cents AS DOUBLE) / CAST(sum(issuance_cents) OVER (PARTITION BY month) AS DOUBLE), 10) AS issuance_share FROM g"


def monthly(spark, sf_dir) -> DataFrame:
    """The issuance roll-up by month."""
    facts = bindings.securities(spark, sf_dir)
    median = order.order_statistics(facts, ["report_period"], "issuance_cents", {"median_cents": order.between(0.5)}, _folder(spark, "medians"))
    by = facts.groupBy("report_period").agg(
        F.count("*").alias("securities"), F.sum("issuance_cents").alias("issuance_cents"), F.sum("current_upb_cents").alias("current_cents"), F.round(F.avg("factor_e8") / 1e8, 8).alias("average_factor"),
        F.sum((F.col("correction_indicator") != "N").cast("long")).alias("revisions"), F.count_distinct("security_id").alias("distinct_securities"), F.count_distinct(F.when(F.col("security_status") == "A", F.col("security_id"))).alias("active_securities"),
    )
    return by.join(median, "report_period", "left")


MONTHLY_SQL = f"WITH {bindings.SECURITY_CTE} SELECT report_period, count(*) AS securities, CAST(sum(issuance_cents) AS BIGINT) AS issuance_cents, CAST(sum(current_upb_cents) AS BIGINT) AS current_cents, round(avg(factor_e8) / 1e8, 8) AS average_factor, CAST(sum(CASE WHEN correction_indicator <> 'N' THEN 1 ELSE 0 END) AS BIGINT) AS revisions, count(DISTINCT security_id) AS distinct_securities, count(DISTINCT CASE WHEN security_status = 'A' THEN security_id END) AS active_securities, CAST(quantile_cont(CAST(issuance_cents AS DOUBLE), 0.5) AS DOUBLE) AS median_cents FROM sec GROUP BY 1"


def states(spark, sf_dir) -> DataFrame:
    out = None
    for v in C.VIEWS:
        h = transitions.history(bindings.loans(spark, sf_dir), v).select(F.lit(v).alias("view"), "source_family", "loan_id", "security_id", "report_period", "active", "upb", "days", "modified")
        out = h if out is None else out.unionByName(h)
    return out


STATES_SQL = f"WITH {bindings.LOAN_CTE}, {cube_sql._HIST} SELECT view, source_family, loan_id, sid AS security_id, report_period, act AS active, u AS upb, d AS days, md AS modified FROM h"


def events(spark, sf_dir) -> DataFrame:
    """What happened between consecutive months of each loan."""
    h = transitions.history(bindings.loans(spark, sf_dir), "latest").where("active")
    later = h.select("source_family", "loan_id", "security_id", (F.col("month") - 1).alias("month"), F.col("days").alias("next_days"))
    both = h.join(later, ["source_family", "loan_id", "security_id", "month"], "left")
    return both.groupBy(S.transition_event(F.col("days"), F.col("next_days")).alias("event")).agg(F.count("*").alias("n"))


EVENTS_SQL = f"""WITH {bindings.LOAN_CTE}, {cube_sql._HIST}, l AS (SELECT * FROM h WHERE view = 'latest' AND act),
p AS (SELECT a.d AS x, b.d AS y FROM l a LEFT JOIN l b ON a.source_family = b.source_family AND a.loan_id = b.loan_id AND a.sid = b.sid AND b.m = a.m + 1),
r AS (SELECT x, y, CASE WHEN x <= 0 THEN 0 WHEN x < 30 THEN 1 WHEN x < 60 THEN 2 WHEN x < 90 THEN 3 ELSE 4 END AS rx, CASE WHEN y <= 0 THEN 0 WHEN y < 30 THEN 1 WHEN y < 60 THEN 2 WHEN y < 90 THEN 3 ELSE 4 END AS ry FROM p)
SELECT CASE WHEN x IS NULL THEN 'ineligible' WHEN y IS NULL THEN 'attrition' WHEN x >= 30 AND y = 0 THEN 'cure' WHEN x <= 0 AND y >= 30 THEN 'new_delinquency' WHEN rx = ry THEN 'stable' WHEN ry > rx THEN 'worsening' ELSE 'improvement' END AS event, count(*) AS n FROM r GROUP BY 1"""


def partials(spark, sf_dir) -> DataFrame:
    p = cube.loan_partials(bindings.loans(spark, sf_dir))
    return p.select("source_file", "report_period", "rows", "active_rows", F.col("active_upb").cast("string").alias("active_upb"), F.col("wala_num").cast("string").alias("wala_num"), F.col("wala_den").cast("string").alias("wala_den"), "wala_obs")


PARTIALS_SQL = f"WITH {bindings.LOAN_CTE}, a AS (SELECT *, {cube_sql._ACTIVE} AS act FROM loan) SELECT source_file, report_period, count(*) AS rows, count(CASE WHEN act THEN 1 END) AS active_rows, CAST(sum(CASE WHEN act THEN current_upb_cents END) AS VARCHAR) AS active_upb, CAST(sum(CASE WHEN act THEN CAST(loan_age AS HUGEINT) * current_upb_cents END) AS VARCHAR) AS wala_num, CAST(sum(CASE WHEN act THEN current_upb_cents END) AS VARCHAR) AS wala_den, count(CASE WHEN act THEN loan_age END) AS wala_obs FROM a GROUP BY 1, 2"


def latency(spark, sf_dir) -> DataFrame:
    """Nearest-rank 95th percentile, peak, trough and largest requester by event type."""
    e = table(spark, sf_dir, "events")
    p95 = order.order_statistics(e, ["event_type"], "value", {"p95": order.nearest(0.95)}, _folder(spark, "p95"))
    by = e.groupBy("event_type").agg(
        F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("peak_event"), F.min_by("event_id", F.struct("value", "event_id")).alias("trough_event"), F.count_distinct("user_id").alias("users")
    )
    return by.join(p95, "event_type", "left")


LATENCY_SQL = "SELECT event_type, quantile_disc(value, 0.95) AS p95, first(event_id ORDER BY value DESC, event_id) AS peak_event, first(event_id ORDER BY value, event_id) AS trough_event, count(DISTINCT user_id) AS users FROM events GROUP BY 1"


def audit(spark, sf_dir) -> DataFrame:
    """The latest 50 requests."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type").orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(50)


def latest_log(spark, sf_dir) -> DataFrame:
    """Last entry of each user in an append-only log, of two types only."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "error"))
    order = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return e.withColumn("k", F.row_number().over(order)).where("k = 1").select("user_id", "event_id", "event_type", "value")


LATEST_LOG_SQL = "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_type IN ('click', 'error')) WHERE k = 1"


def leak_scan(spark, sf_dir) -> DataFrame:
    """Files that contain a token of a customer."""
    tokens = table(spark, sf_dir, "customer").select(F.regexp_extract("c_name", "([0-9]+)", 1).alias("token"))
    files = table(spark, sf_dir, "supplier").select(F.concat(F.lit("file-"), F.col("s_suppkey").cast("string")).alias("path"), F.col("s_name").alias("value"))
    return leaks.leaked(tokens, files.withColumn("value", F.translate("value", "#", " ")))


LEAK_SQL = "WITH t AS (SELECT DISTINCT regexp_extract(c_name, '([0-9]+)', 1) AS token FROM customer) SELECT 'file-' || CAST(s_suppkey AS VARCHAR) AS path, token FROM supplier JOIN t ON length(token) >= 5 AND contains(translate(s_name, '#', ' '), token)"


def leak_sample(spark, sf_dir) -> DataFrame:
    """Files of the archives that contain a token sampled from another one's first lines."""
    lines = bindings.archive_lines(spark, sf_dir, _folder(spark, "lines"))
    tokens = leaks.sampled_tokens(lines)
    files = lines.where("line > 1").select(F.col("file").alias("path"), "value")
    found = leaks.leaked(tokens.select("token"), files)
    return found.groupBy("path").agg(F.count("*").alias("tokens"))


def partition_totals(spark, sf_dir) -> DataFrame:
    """What a partition's formats are compared by: rows, balance, corrections and matches of each loan file."""
    return bindings.loans(spark, sf_dir).groupBy("source_file").agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("current_upb_cents"), F.lit(0)).cast("long").alias("current_upb_cents"), F.count(F.when(F.col("correction_indicator") != "N", 1)).alias("corrections"), F.count(F.when(F.col("join_reason") == "matched", 1)).alias("matched")
    )


PARTITION_TOTALS_SQL = f"WITH {bindings.LOAN_CTE} SELECT source_file, count(*) AS rows, CAST(coalesce(sum(current_upb_cents), 0) AS BIGINT) AS current_upb_cents, count(CASE WHEN correction_indicator <> 'N' THEN 1 END) AS corrections, count(CASE WHEN join_reason = 'matched' THEN 1 END) AS matched FROM loan GROUP BY 1"


def set_difference(spark, sf_dir) -> DataFrame:
    """Expected months without a package, and packages outside the expected months."""
    expected = population.month_spine(windows(spark))
    got = received(spark, sf_dir)
    absent = expected.join(got, ["family", "report_period"], "left_anti").withColumn("problem", F.lit("absent"))
    return absent.unionByName(got.join(expected, ["family", "report_period"], "left_anti").withColumn("problem", F.lit("unexpected")))


SET_SQL = COMPLETENESS_SQL + " SELECT family, report_period, 'absent' AS problem FROM (SELECT family, report_period FROM e EXCEPT SELECT family, report_period FROM g) UNION ALL SELECT family, report_period, 'unexpected' FROM (SELECT family, report_period FROM g EXCEPT SELECT family, report_period FROM e)"


def formulas(spark, sf_dir) -> DataFrame:
    """Prepayment rates and the balance bridge; computed, never released."""
    p = table(spark, sf_dir, "part")
    monthly_rate = S.smm(F.col("p_size") % 11, F.col("p_size") + F.lit(0))
    return p.select("p_partkey", F.round(monthly_rate, 10).alias("smm"), F.round(S.cpr(monthly_rate), 10).alias("cpr"), S.ending_residual(F.col("p_partkey") * 100, F.lit(5), F.lit(0), F.lit(3), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.col("p_partkey") * 100).alias("residual"), S.comparability(F.col("p_size") % 2, F.col("p_size") % 3).alias("comparability"), S.percent(F.col("p_size") / F.lit(50)).alias("share_text"), F.round(S.percent_change(F.col("p_size"), F.col("p_partkey")), 10).alias("change"))


FORMULAS_SQL = """WITH a AS (SELECT *, CASE WHEN p_size > 0 THEN CAST(p_size % 11 AS DOUBLE) / p_size END AS m FROM part)
SELECT p_partkey, round(m, 10) AS smm, round(1 - pow(1 - m, 12), 10) AS cpr, CAST(0 AS BIGINT) AS residual, CASE WHEN p_size % 2 > 0 THEN 'fail' WHEN p_size % 3 > 0 THEN 'warn' ELSE 'pass' END AS comparability,
printf('%.2f%%', CAST(p_size AS DOUBLE) / 50 * 100) AS share_text, CASE WHEN p_partkey <> 0 THEN round(CAST(p_size AS DOUBLE) / p_partkey - 1, 10) END AS change FROM a"""


def series(spark, sf_dir) -> DataFrame:
    """Payload series: months in which all eight required measures exist, one column for each measure."""
    from .plans.payload import CONTRACTS, series as pivoted

    return pivoted(metric(spark, sf_dir, CONTRACTS), "latest")


SERIES_SQL = (
    "WITH " + ", ".join([bindings.SECURITY_CTE, bindings.LOAN_CTE, cube_sql._LOAN_ACTIVE, cube_sql._VIEWS])
    + ", l AS (SELECT report_period, count(*) AS n, sum(current_upb_cents) AS u, " + ", ".join(f"round(CAST(count(CASE WHEN days_delinquent >= {d} THEN 1 END) AS DOUBLE) / nullif(count(days_delinquent), 0), 10) AS d{d}" for d in (30, 60, 90))
    + ", round(CAST(count(CASE WHEN trim(coalesce(modification_program, '')) <> '' THEN 1 END) AS DOUBLE) / count(*), 10) AS m FROM act GROUP BY 1), "
    "k AS (SELECT report_period, CAST(count(CASE WHEN correction_indicator <> 'N' THEN 1 END) AS DOUBLE) AS k FROM loan GROUP BY 1), "
    f"s AS (SELECT report_period, CAST(count(CASE WHEN {cube_sql._ACTIVE_SEC} THEN 1 END) AS DOUBLE) AS n, round(sum(CASE WHEN {cube_sql._ACTIVE_SEC} THEN current_upb_cents ELSE 0 END) / 100.0, 2) AS u FROM late GROUP BY 1) "
    "SELECT report_period, CAST(l.n AS DOUBLE) AS loan_count, round(l.u / 100.0, 2) AS loan_upb, round(CAST(l.u AS DOUBLE) / l.n / 100, 6) AS average_current_loan_balance, s.n AS security_count, s.u AS security_upb, d30 AS \"30_plus_count\", d60 AS \"60_plus_count\", d90 AS \"90_plus_count\", m AS modification_count_rate, k AS loan_correction_count FROM l JOIN k USING (report_period) LEFT JOIN s USING (report_period) WHERE d30 IS NOT NULL"
)


def concentration(spark, sf_dir) -> DataFrame:
    """Dimensions by the share of their ten largest members in the last month, with a cue at one half."""
    from .plans.payload import concentration as ranked

    return ranked(metric(spark, sf_dir, ("state_composition", "counterparty_composition")))




CONCENTRATION_SQL = (
    f"WITH {bindings.LOAN_CTE}, {cube_sql._LOAN_ACTIVE}, d AS (SELECT report_period, 'state' AS dimension, property_state AS m, current_upb_cents AS u FROM act UNION ALL SELECT report_period, 'seller', seller_name, current_upb_cents FROM act UNION ALL SELECT report_period, 'servicer', servicer_name, current_upb_cents FROM act), "
    "g AS (SELECT report_period, dimension, m, sum(u) AS u FROM d WHERE report_period = (SELECT max(report_period) FROM act) GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY u DESC, m) AS k FROM g) "
    "SELECT report_period, dimension, round(CAST(sum(CASE WHEN k <= 10 THEN u ELSE 0 END) AS DOUBLE) / sum(u), 10) AS share, CAST(sum(CASE WHEN k <= 10 THEN u ELSE 0 END) AS DOUBLE) / sum(u) >= 0.5 AS concentrated FROM r GROUP BY 1, 2"
)


#: Contracts that hold the evidence.
EVIDENCE_CONTRACTS = ("current_outstanding_balance_population", "modification_rate", "counterparty_composition", "state_composition", "delinquency_roll_cure")


def source_partitions(loans: DataFrame) -> DataFrame:
    """Rows and checksum of each loan file's month; a bigint would not hold the sum of some hundred row numbers."""
    return loans.groupBy("report_period", "source_file").agg(F.count("*").alias("rows"), F.sum(S.wide(F.col("source_row"))).cast("string").alias("checksum"))


def payload_evidence(spark, sf_dir) -> DataFrame:
    """The last month's evidence with the number of its source partitions and of their rows."""
    from .plans.payload import evidence

    partitions = source_partitions(bindings.loans(spark, sf_dir))
    built = release.staged(metric(spark, sf_dir, EVIDENCE_CONTRACTS), _folder(spark, "evidence"))  # read twice
    out = evidence(built, partitions)
    return out.select("evidence", "component", "report_period", "member", F.col("numerator").cast("string").alias("numerator"), F.size("provenance").cast("long").alias("partitions"), F.aggregate("provenance", F.lit(0).cast("long"), lambda n, p: n + p["rows"]).alias("source_rows"))


def _evidence_sql() -> str:
    from .plans.payload import EVIDENCE

    cubes = " UNION ALL ".join(f"(SELECT * FROM ({cube_sql.transition_sql(c) if c == 'delinquency_roll_cure' else cube_sql.contract_sql(c)}))" for c in EVIDENCE_CONTRACTS)
    names = " ".join(f"WHEN '{v}' THEN '{k}'" for k, v in EVIDENCE.items())
    return (
        f"WITH {bindings.LOAN_CTE}, c AS (SELECT * FROM ({cubes}) WHERE correction_view = 'latest'), e AS (SELECT *, CASE component {names} WHEN 'transition_count' THEN 'transitions' END AS evidence FROM c), "
        "x AS (SELECT * FROM e WHERE evidence IS NOT NULL AND report_period = (SELECT max(report_period) FROM e WHERE evidence IS NOT NULL AND evidence <> 'transitions')), "
        "p AS (SELECT report_period, count(DISTINCT source_file) AS k, count(*) AS n FROM loan GROUP BY 1) "
        "SELECT evidence, component, report_period, member, numerator, CAST((SELECT sum(k) FROM p WHERE p.report_period = x.report_period OR (evidence = 'transitions' AND p.report_period = strftime(CAST(x.report_period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m'))) AS BIGINT) AS partitions, "
        "CAST((SELECT sum(n) FROM p WHERE p.report_period = x.report_period OR (evidence = 'transitions' AND p.report_period = strftime(CAST(x.report_period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m'))) AS BIGINT) AS source_rows FROM x"
    )


def findings(spark, sf_dir) -> DataFrame:
    """Issuance of each month against the one before, with peak and trough."""
    from .plans.payload import findings as found

    return found(bindings.securities(spark, sf_dir).groupBy("report_period").agg(F.sum("issuance_cents").alias("upb")))


FINDINGS_SQL = f"WITH {bindings.SECURITY_CTE}, m AS (SELECT report_period, CAST(sum(issuance_cents) AS BIGINT) AS upb FROM sec GROUP BY 1) SELECT report_period, upb, round(CAST(upb AS DOUBLE) / lag(upb) OVER (ORDER BY report_period) - 1, 10) AS change, report_period = (SELECT report_period FROM m ORDER BY upb DESC, report_period LIMIT 1) AS peak, report_period = (SELECT report_period FROM m ORDER BY upb, report_period LIMIT 1) AS trough FROM m"


def raw_lines(spark, sf_dir) -> DataFrame:
    """Delimited lines of two record types and uneven widths, in files by user."""
    e = table(spark, sf_dir, "events")
    extra = F.when(F.col("event_id") % 10 == 0, "|x").when(F.col("event_id") % 15 == 0, "|").otherwise("")
    return e.select(F.concat(F.lit("f"), (F.col("user_id") % 7).cast("string")).alias("file"), F.concat(F.col("event_type"), F.lit("|"), F.col("user_id").cast("string"), extra).alias("value"))


PROFILE_SQL = """WITH l AS (SELECT 'f' || CAST(user_id % 7 AS VARCHAR) AS file, event_type AS record_type, 2 + CASE WHEN event_id % 10 = 0 OR event_id % 15 = 0 THEN 1 ELSE 0 END AS width FROM events)
SELECT file, record_type, CAST(width AS INT) AS width, count(*) AS rows FROM l GROUP BY 1, 2, 3"""


def family_match(spark, sf_dir) -> DataFrame:
    """Families and months from file names, and why a name is not taken."""
    names = table(spark, sf_dir, "orders").select(F.concat(F.when(F.col("o_orderkey") % 5 == 0, "XX").when(F.col("o_orderkey") % 2 == 0, "IS").otherwise("LL"), F.lit("_"), F.date_format("o_orderdate", "yyyyMM"), F.when(F.col("o_orderkey") % 9 == 0, ".txt").otherwise(".zip")).alias("file")).distinct()
    families = [{"id": i, "pattern": rf"^{p}_(?P<year>(?:19|20)\d{{2}})(?P<month>0[1-9]|1[0-2])\.zip$"} for i, p in (("issuance", "IS"), ("loans", "LL"))]
    found = archives.matched(names, families)
    return found.select("file", "family", "report_period", F.when(F.col("matches") == 0, "no family matches").alias("blocker"))


FAMILY_SQL = """WITH n AS (SELECT DISTINCT CASE WHEN o_orderkey % 5 = 0 THEN 'XX' WHEN o_orderkey % 2 = 0 THEN 'IS' ELSE 'LL' END || '_' || strftime(o_orderdate, '%Y%m') || CASE WHEN o_orderkey % 9 = 0 THEN '.txt' ELSE '.zip' END AS file FROM orders),
f AS (SELECT file, CASE WHEN file LIKE 'IS%.zip' THEN 'issuance' WHEN file LIKE 'LL%.zip' THEN 'loans' END AS family FROM n)
SELECT file, family, CASE WHEN family IS NOT NULL THEN substr(file, 4, 4) || '-' || substr(file, 8, 2) END AS report_period, CASE WHEN family IS NULL THEN 'no family matches' END AS blocker FROM f"""


def header_hashes(spark, sf_dir) -> DataFrame:
    """Hashes of ordered headers, one for each nation's variant."""
    n = table(spark, sf_dir, "nation")
    columns = F.when(F.col("n_nationkey") % 3 == 0, F.array(F.lit("Prefix"), F.lit("Status"))).otherwise(F.array(F.lit("Prefix"), F.col("n_name"), F.lit("UPB")))
    return n.select("n_nationkey", F.size(columns).alias("width"), population.header_hash(columns).alias("header_sha256"), S.record_hash(F.col("n_name"), F.when(F.col("n_nationkey") > 5, F.col("n_regionkey"))).alias("record_sha256"))


HEADER_SQL = "SELECT n_nationkey, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 3 END AS INT) AS width, sha256(CASE WHEN n_nationkey % 3 = 0 THEN 'Prefix|Status' ELSE 'Prefix|' || n_name || '|UPB' END) AS header_sha256, sha256(n_name || chr(31) || coalesce(CAST(CASE WHEN n_nationkey > 5 THEN n_regionkey END AS VARCHAR), '')) AS record_sha256 FROM nation"


def stale_sources(spark, sf_dir) -> DataFrame:
    """Loan files to build again: another row count, or built under another fingerprint."""
    from .plans.release import stale

    now = bindings.loans(spark, sf_dir).groupBy("source_file", "report_period").agg(F.count("*").alias("rows")).select(F.concat_ws("/", "report_period", "source_file").alias("source_file"), F.lit("c").alias("checksum"), "rows")
    built = now.withColumn("rows", F.when(F.col("rows") % 5 == 0, F.col("rows") + 1).otherwise(F.col("rows"))).withColumn("fingerprint", F.when(F.col("source_file").endswith("F3"), "old").otherwise("new"))
    return stale(now, built, "new").select("source_file", "rows")


STALE_SQL = f"WITH {bindings.LOAN_CTE}, n AS (SELECT report_period || '/' || source_file AS source_file, count(*) AS rows FROM loan GROUP BY report_period, source_file, 1) SELECT source_file, rows FROM n WHERE rows % 5 = 0 OR source_file LIKE '%F3'"


def constant_columns(spark, sf_dir) -> DataFrame:
    """Columns that are not constant within a month and file, so cannot move into the path."""
    from .plans.release import constant_columns as varying

    loans = bindings.loans(spark, sf_dir).select(F.concat_ws("/", "report_period", "source_file").alias("part"), "as_of_timestamp", "prefix", "report_period")
    return varying(loans, "part", ["as_of_timestamp", "prefix", "report_period"])


CONSTANT_SQL = f"WITH {bindings.LOAN_CTE} SELECT report_period || '/' || source_file AS part, count(DISTINCT as_of_timestamp) AS as_of_timestamp, count(DISTINCT prefix) AS prefix, count(DISTINCT report_period) AS report_period FROM loan GROUP BY report_period || '/' || source_file HAVING count(DISTINCT as_of_timestamp) > 1 OR count(DISTINCT prefix) > 1 OR count(DISTINCT report_period) > 1"


def fingerprint(spark, sf_dir) -> DataFrame:
    """The order-free fingerprint of a cube."""
    return verify.snapshot(metric(spark, sf_dir, ("issuance_volume",))).select("rows", F.col("fingerprint").cast("string").alias("fingerprint"))


FINGERPRINT_SQL = f"SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', contract_id, component, report_period, correction_view, grain, dimension, member, numerator, coalesce(denominator, ''), CAST(observations AS VARCHAR))), 1, 8) AS BIGINT)) AS VARCHAR) AS fingerprint FROM ({cube_sql.contract_sql('issuance_volume')})"


def event_windows(spark, sf_dir) -> DataFrame:
    """The streaming windows, over the whole table as a batch."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("value", F.col("value").cast("decimal(20,4)"))
    out = streams.windowed(e, "1 hour", "1 hour")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round(F.col("total").cast("double"), 4).alias("total"))


EVENT_WINDOWS_SQL = "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(CAST(sum(CAST(value AS DECIMAL(20,4))) AS DOUBLE), 4) AS total FROM events GROUP BY 1, 2"


def event_sessions(spark, sf_dir) -> DataFrame:
    """The streaming sessions of each user, cut at half an hour without events, as a batch."""
    return streams.sessions(table(spark, sf_dir, "events"), "30 minutes").select("user_id", "n", "first_event")


EVENT_SESSIONS_SQL = "WITH a AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS cut FROM events), b AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM a) SELECT user_id, count(*) AS n, min(event_id) AS first_event FROM b GROUP BY user_id, s"


# ---- builds that read only what changed


def _folder(spark, name: str) -> str:
    return f"{parts.workspace(spark)}/{name}-{uuid.uuid4().hex}"


LOAN_PERIOD = (*LOAN_CONTRACTS, *DERIVED)


def incremental_loans(spark, sf_dir) -> DataFrame:
    """Loan contracts after an update: an earlier state of one file and a file that is gone were built before; the update
    reads the one that changed and the one that is new, and keeps the partials of the others."""
    loans = bindings.kept_loans(spark, sf_dir, _folder(spark, "loans"))
    store = incremental.LoanStore(spark, _folder(spark, "loan-store"), "rules-1")

    def of(frame: DataFrame):
        by = frame.groupBy("source_file").agg(F.count("*").alias("rows"), F.sum(parts.row_digest(["loan_id", "source_row", "current_upb_cents"])).cast("string").alias("checksum"))
        return release.staged(by.select("source_file", "checksum", "rows"), _folder(spark, "loan-files")), lambda files: frame.where(F.col("source_file").isin(files))

    upb = F.when(F.col("source_file") == "F3", F.col("current_upb_cents") + 100).otherwise(F.col("current_upb_cents"))
    earlier = loans.where("source_file != 'F2'").withColumn("current_upb_cents", upb).unionByName(loans.where("source_file = 'F1'").withColumn("source_file", F.lit("F9")))
    store.update(*of(earlier))
    store.update(*of(loans))
    return as_text(store.cube())


INCREMENTAL_LOANS_SQL = "SELECT * FROM (" + " UNION ALL ".join(f"(SELECT * FROM ({cube_sql.contract_sql(c)}))" for c in LOAN_PERIOD) + ") WHERE grain = 'loan-period'"

#: Months that the query adds one by one to a history.
ADVANCED = 4


def incremental_transitions(spark, sf_dir) -> DataFrame:
    """Both transition contracts from a history and its last months, added one at a time to the frontier before them."""
    loans = bindings.kept_loans(spark, sf_dir, _folder(spark, "loans"), transitions.NEEDED)
    months = sorted(r.report_period for r in loans.select("report_period").distinct().collect())  # one row for each month
    store = incremental.TransitionStore(spark, _folder(spark, "transitions"))
    store.start(loans.where(F.col("report_period") <= months[-1 - ADVANCED]))
    for month in months[-ADVANCED:]:
        store.advance(loans.where(F.col("report_period") == month))
    return as_text(store.cube(loans.select("report_period").distinct()))


def late_securities(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loans, and the securities of the join in those that were there and those that come late."""
    securities = bindings.securities(spark, sf_dir).select("source_id", F.col("join_security_id").alias("security_id"), "report_period", "security_status")
    late = F.col("source_id") % 7 == 3
    return bindings.loans(spark, sf_dir).drop("join_reason"), securities.where(~late).drop("source_id"), securities.where(late).drop("source_id")


def join_repair(spark, sf_dir) -> DataFrame:
    """Join counts after late securities, repaired where these change a reason; the same as of a join with all of them."""
    loans, before, late = late_securities(spark, sf_dir)
    store = repair.JoinedLoans(spark, _folder(spark, "joined"))
    store.publish(population.join_reason(loans.select("loan_id", "security_id", "report_period", "source_row", "correction_indicator"), before))
    store.repair(before, late)
    return store.counts.read().select("report_period", "join_reason", "row_count")


def committed_parts(spark, sf_dir) -> DataFrame:
    """Loan files after two gated commits: one whole, one that replaces half of them; rows and balance of each."""
    loans = bindings.loans(spark, sf_dir).select(F.col("source_file").alias("part"), "loan_id", "report_period", "source_row", "current_upb_cents")
    table_ = parts.Parts(spark, _folder(spark, "parts"))
    for frame in (loans.withColumn("current_upb_cents", F.col("current_upb_cents") + 1), loans.where("part in ('F1', 'F3')")):
        kept = release.staged(frame, f"{table_.root}/building")
        table_.commit(kept, parts.digests(kept))
    return table_.read().groupBy(F.col("part").alias("source_file")).agg(F.count("*").alias("rows"), F.sum("current_upb_cents").alias("upb"))


COMMITTED_SQL = f"WITH {bindings.LOAN_CTE} SELECT source_file, count(*) AS rows, CAST(sum(CASE WHEN source_file IN ('F1', 'F3') THEN current_upb_cents ELSE current_upb_cents + 1 END) AS BIGINT) AS upb FROM loan GROUP BY 1"


# ---- streams


#: Years of arrivals that are one run of a stream.
ARRIVAL_YEARS = 3
#: A month after all others, with which the watermark passes these.
AFTER_ALL = "2199-12"


def _arrival(months_later: int) -> Column:
    """The run in which a row comes, ``months_later`` after its month."""
    month = F.substring("report_period", 1, 4).cast("int") * 12 + F.substring("report_period", 6, 2).cast("int") - 1 + months_later
    return F.floor(month / (12 * ARRIVAL_YEARS)).cast("int").alias("arrival")


def streamed(spark, name: str, sources: list[tuple[DataFrame, list[dict]]], build: Callable[..., DataFrame]) -> DataFrame:
    """What ``build`` of the sources' streams gives, run by run of their arrivals, each run resuming from the one before.

    A source: its rows with ``arrival``, and the rows that come last."""
    folder = _folder(spark, name)
    runs, schemas = set(), []
    for i, (frame, _) in enumerate(sources):
        frame.write.partitionBy("arrival").parquet(f"{folder}/arrivals-{i}")
        kept = spark.read.parquet(f"{folder}/arrivals-{i}")
        runs |= {r.arrival for r in kept.select("arrival").distinct().collect()}  # one row for some years
        schemas.append(kept.drop("arrival").schema)
    for run in [*sorted(runs), None]:
        for i, (_, last) in enumerate(sources):
            rows = spark.read.parquet(f"{folder}/arrivals-{i}").where(F.col("arrival") == run).drop("arrival") if run is not None else spark.createDataFrame([tuple(r.get(c) for c in schemas[i].names) for r in last], schemas[i])
            rows.write.mode("append").parquet(f"{folder}/in-{i}")
        built = build(*(spark.readStream.schema(s).parquet(f"{folder}/in-{i}") for i, s in enumerate(schemas)))
        writer = built.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True)
        cohorts.started(writer, spark).awaitTermination()
    return spark.read.schema(built.schema).parquet(f"{folder}/out")


def streamed_join(spark, sf_dir) -> DataFrame:
    """Join counts of loans and securities that arrive over years, every seventh security a quarter late."""
    loans, before, late = late_securities(spark, sf_dir)
    loans = loans.select("security_id", "report_period", "correction_indicator", _arrival(0))
    securities = before.select("*", _arrival(0)).unionByName(late.select("*", _arrival(3)))
    last = {"security_id": "", "report_period": AFTER_ALL, "security_status": "A"}
    found = streamed(spark, "stream-join", [(loans, [last, last | {"correction_indicator": "D"}]), (securities, [last])], lambda a, b: joins.reason_counts(a, b, delay="124 days", wait=120))
    return found.where(F.col("report_period") != AFTER_ALL).groupBy("report_period", "join_reason").agg(F.sum("row_count").alias("row_count"))


def streamed_cohorts(spark, sf_dir) -> DataFrame:
    """Cohort components of the latest view: a history's, and those that a stream of the later months ends or starts."""
    loans = bindings.kept_loans(spark, sf_dir, _folder(spark, "loans"), transitions.NEEDED)
    months = sorted(r.report_period for r in loans.select("report_period").distinct().collect())  # one row for each month
    cut = months[len(months) // 2]
    store = incremental.TransitionStore(spark, _folder(spark, "stream-history"))
    store.start(loans.where(F.col("report_period") <= cut))
    frontier = cohorts.frontier_states(store.frontiers.read([cut]))
    later = loans.where(F.col("report_period") > cut).select(*transitions.NEEDED, _arrival(0))
    last = {c: "" for c in transitions.NEEDED} | {"report_period": AFTER_ALL, "source_row": 0, "current_upb_cents": 0, "days_delinquent": 0}
    found = streamed(spark, "stream-cohorts", [(later, [last])], lambda s: cohorts.outcomes(cohorts.states(s), initial=frontier))
    ended = found.groupBy("kind", transitions._period(F.col("month")).alias("report_period"), F.col("status").alias("result")).agg(F.count("*").alias("n"), F.sum("upb").cast("decimal(38,0)").alias("upb")).withColumn("correction_view", F.lit("latest"))
    before = store.sums.read().where("correction_view = 'latest' and kind != 'transition'").select(*ended.columns)
    return as_text(transitions.cohort_rows(before.unionByName(ended), loans, ("latest",)))


# ---- conformance from archive lines


def conformed(spark, sf_dir, **columns: tuple[str, ...]) -> conformance.Conformed:
    """The archives' rows, judged and joined; of facts the ``columns`` by kind, as a query reads them."""
    folder = _folder(spark, "conformance")

    def keep(frame: DataFrame) -> DataFrame:
        return archives.stored(frame, folder)

    lines, contract = bindings.archive_lines(spark, sf_dir, folder), bindings.archive_contract()
    heads = keep(archives.headers(lines))
    return conformance.conform(lines, keep(archives.inventory(lines, contract, heads=heads)), bindings.ARCHIVE_ALIASES, keep=keep, columns=columns, loans_read_once=True, heads=heads)


CONFORMED_SECURITY = ("report_period", "security_id", "prefix", "security_status", "correction_indicator", "factor_e8", "current_upb_cents", "issue_date", "green_indicator", "v2_field_statuses", "publication_date", "source_file")
CONFORMED_LOAN = ("report_period", "loan_id", "security_id", "correction_indicator", "current_upb_cents", "days_delinquent", "join_reason", "as_of_timestamp")


def conformed_securities(spark, sf_dir) -> DataFrame:
    return conformed(spark, sf_dir, security=CONFORMED_SECURITY).securities.select(*CONFORMED_SECURITY)


def conformed_loans(spark, sf_dir) -> DataFrame:
    return conformed(spark, sf_dir, loan=CONFORMED_LOAN).loans.select(*CONFORMED_LOAN)


LEAK_SAMPLE_SQL = f"""
WITH {bindings.SECURITY_LINES_CTE}, {bindings.LOAN_LINES_CTE},
s AS (SELECT file, "Security Identifier" AS a, NULL AS b, row_number() OVER (PARTITION BY file ORDER BY row_key) AS k FROM fd UNION ALL SELECT file, "Security Identifier", "Loan Identifier", row_number() OVER (PARTITION BY file ORDER BY row_key) FROM fu),
t AS (SELECT DISTINCT trim(token) AS token FROM (SELECT unnest([a, b]) AS token FROM s WHERE k <= 25) WHERE length(trim(token)) >= 5),
v AS (SELECT file, concat_ws('|', {{security}}) AS value FROM fd UNION ALL SELECT file, concat_ws('|', {{loan}}) FROM fu),
w AS (SELECT file, string_agg(value, chr(10)) AS value FROM v GROUP BY 1)
SELECT file || '.zip' AS path, count(*) AS tokens FROM w JOIN t ON contains(value, token) GROUP BY 1
""".format(**{k: ", ".join(f'"{c}"' for c in columns if c not in ("file", "row_key")) for k, columns in (("security", bindings.SECURITY_LINES), ("loan", bindings.LOAN_LINES))})


#: Rows of both kinds of archives with the reason that rejects them, then the first of each key.
CONFORMED_CTE = f"""
{bindings.SECURITY_LINES_CTE}, {bindings.LOAN_LINES_CTE},
se AS (SELECT *, '20' || substr(file, 3, 2) || '-' || substr(file, 5, 2) AS period, CASE WHEN trim("Security Identifier") = '' THEN 'security business key is incomplete' WHEN "Security Factor Date" = '131999' THEN 'Security Factor Date is not MMCCYY'
  WHEN "Security Data Correction Indicator" = '?' THEN 'Security Data Correction Indicator is invalid' WHEN "Security Factor" = 'x' THEN 'Security Factor is not a valid decimal' WHEN "Issue Date" = '01022025' THEN 'issue_date has an invalid provider-defaulted day' END AS error FROM fd),
sd AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'rejected' WHEN row_number() OVER (PARTITION BY period, "Security Identifier", error IS NULL ORDER BY row_key) > 1 THEN 'duplicate' ELSE 'accepted' END AS disposition FROM se),
le AS (SELECT *, '20' || substr(file, 3, 2) || '-' || substr(file, 5, 2) AS period, CASE WHEN "Loan Correction Indicator" = 'Z' THEN 'Loan Correction Indicator is invalid' END AS error FROM fu),
ld AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'rejected' WHEN row_number() OVER (PARTITION BY period, "Loan Identifier", "Security Identifier", error IS NULL ORDER BY row_key) > 1 THEN 'duplicate' ELSE 'accepted' END AS disposition FROM le),
al AS (SELECT file, period, 'monthly-security-core-1' AS family, disposition, 'SECURITY' AS kind, error FROM sd UNION ALL SELECT file, period, 'monthly-loan-level-1', disposition, 'LOAN', error FROM ld),
cm AS (SELECT *, rejected_count + duplicate_count AS quarantined_count, CASE WHEN rejected_count + duplicate_count > 0 THEN 'fail' ELSE 'pass' END AS quality_status, CASE WHEN rejected_count + duplicate_count > 0 THEN 0 ELSE accepted_count END AS published_count FROM
  (SELECT file || '.zip' AS source_file, family AS source_family, period AS report_period, count(*) AS input_count, count(CASE WHEN disposition = 'accepted' THEN 1 END) AS accepted_count, CAST(0 AS BIGINT) AS excluded_count, count(CASE WHEN disposition = 'rejected' THEN 1 END) AS rejected_count, count(CASE WHEN disposition = 'duplicate' THEN 1 END) AS duplicate_count FROM al GROUP BY 1, 2, 3)),
ps AS (SELECT sd.* FROM sd JOIN cm ON sd.file || '.zip' = source_file WHERE quality_status = 'pass'), pl AS (SELECT ld.* FROM ld JOIN cm ON ld.file || '.zip' = source_file WHERE quality_status = 'pass'),
lp AS (SELECT "Security Identifier" AS sid, max(period) AS last FROM ps GROUP BY 1), m AS (SELECT "Security Identifier" AS sid, period, count(*) AS n, max(CASE WHEN "Security Status Indicator" = 'P' THEN 1 ELSE 0 END) AS ended FROM ps GROUP BY 1, 2),
jl AS (SELECT pl.*, CASE WHEN "Loan Correction Indicator" = 'D' OR ended = 1 THEN 'terminated' WHEN "Security Identifier" = '' THEN 'ineligible' WHEN n > 1 THEN 'ambiguous' WHEN n = 1 THEN 'matched' WHEN last > pl.period THEN 'late' ELSE 'unmatched' END AS join_reason
  FROM pl LEFT JOIN m ON m.sid = "Security Identifier" AND m.period = pl.period LEFT JOIN lp ON lp.sid = "Security Identifier")
"""
CONFORMED_SECURITIES_SQL = f"""WITH {CONFORMED_CTE} SELECT period AS report_period, "Security Identifier" AS security_id, "Prefix" AS prefix, "Security Status Indicator" AS security_status, "Security Data Correction Indicator" AS correction_indicator,
CAST(CASE WHEN "Security Factor" = '.5' THEN 50000000 END AS BIGINT) AS factor_e8, CAST(row_key * 100 + 25 AS BIGINT) AS current_upb_cents, CASE WHEN "Issue Date" = '01012025' THEN '2025-01-01' END AS issue_date, CASE WHEN "Green Indicator" = 'Y' THEN 'Y' END AS green_indicator,
CASE WHEN "Issue Date" = '' THEN '0' ELSE 'V' END || '000' || CASE WHEN "Prefix" = '1A' THEN 'A' ELSE '0' END || CASE WHEN "Prefix" = 'MA' THEN 'AA' ELSE '00' END || '0' || CASE WHEN "Prefix" = 'MA' THEN '0' ELSE 'A' END || '00' || CASE "Green Indicator" WHEN 'Y' THEN 'V' WHEN '9' THEN 'N' ELSE '0' END || '00' AS v2_field_statuses,
'20' || substr(file, 3, 2) || '-' || substr(file, 5, 2) || '-07' AS publication_date, file || '.zip' AS source_file FROM ps"""
CONFORMED_LOANS_SQL = f"""WITH {CONFORMED_CTE} SELECT period AS report_period, "Loan Identifier" AS loan_id, nullif("Security Identifier", '') AS security_id, "Loan Correction Indicator" AS correction_indicator, CAST("Current Investor Loan UPB" AS BIGINT) * 100 AS current_upb_cents,
CAST(nullif("Days Delinquent", '') AS BIGINT) AS days_delinquent, join_reason, period || '-07T23:59:59Z' AS as_of_timestamp FROM jl"""


def resume_scope(spark, sf_dir) -> DataFrame:
    """What keeps sources from passing, once each: the scope that a resumed run has to clear."""
    found = conformed(spark, sf_dir)
    failing = found.manifest.where("quality_status != 'pass'").select("source_file")
    return found.issues.join(failing, "source_file").select("detail").distinct()


def _check(of: Callable[[SparkSession, str], DataFrame]) -> Query:
    """Counts the rows that break an invariant."""
    return lambda s, d: of(s, d).agg(F.count("*").alias("broken"))


NONE_SQL = "SELECT CAST(0 AS BIGINT) AS broken"


def _whole_and_parts(spark, sf_dir) -> DataFrame:
    loans = bindings.loans(spark, sf_dir)
    return verify.consolidation(cube.loan_partials(loans, ("report_period",)), cube.consolidated(cube.loan_partials(loans)))


def _mix_reconciles(spark, sf_dir) -> DataFrame:
    by = mix(spark, sf_dir).select("month", "security_count", F.col("issuance_cents").alias("issuance"), F.col("issuance_share").alias("share"))
    months = bindings.securities(spark, sf_dir).groupBy(F.col("report_period").alias("month")).agg(F.count("*").alias("security_count"), F.sum("issuance_cents").alias("issuance"))
    return verify.mix_reconciles(by, months)


_BUILT: dict[tuple[str, str], str] = {}


def whole_cube(spark, sf_dir) -> DataFrame:
    """The cube of all contracts, written once in a session, as several checks look at all of it."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _BUILT:
        path = _folder(spark, "cube")
        metric(spark, sf_dir).write.parquet(path)
        _BUILT[at] = path
    return spark.read.parquet(_BUILT[at])


def checks() -> dict[str, Query]:
    """Counts of what breaks each invariant. Checks of single contracts build these; the others look at the whole cube."""
    m = metric
    loans = bindings.loans

    def removal(s, d):
        rows = m(s, d, ("involuntary_removal_share",))
        return cube.union(verify.removal_recomputed(rows, f, v) for v, f in views(s, d).items())

    return {
        "v01_contract_set": _check(lambda s, d: verify.contract_set(whole_cube(s, d))),
        "v02_partition_bridge": _check(lambda s, d: verify.partition_bridge(cube.loan_partials(loans(s, d)), loans(s, d).groupBy("source_file", "report_period").agg(F.count("*").alias("rows")))),
        "v03_view_coverage": _check(lambda s, d: verify.view_coverage(m(s, d, ("current_outstanding_balance_population",)), bindings.securities(s, d).where("quality_status = 'pass'").select("report_period"))),
        "v03_schema_coverage": _check(lambda s, d: verify.schema_coverage(m(s, d, ("schema_transition_status",)), manifests(s, d))),
        "v04_segment_sums": _check(lambda s, d: verify.segment_sums(m(s, d, LOAN_CONTRACTS))),
        "v05_score_sums": _check(lambda s, d: verify.segment_sums(m(s, d, ("credit_score_model_metrics", "guarantee_mi_share")))),
        "v06_summaries": _check(lambda s, d: verify.summaries(m(s, d, ("state_composition", "counterparty_composition")))),
        "v07_hhi": _check(lambda s, d: verify.hhi_recomputed(m(s, d, ("state_composition", "counterparty_composition", "hhi_concentration")))),
        "v08_weighted": _check(lambda s, d: verify.weighted_recomputed(whole_cube(s, d))),
        "v09_thresholds": _check(lambda s, d: verify.thresholds_recomputed(m(s, d, ("delinquency_threshold_rates",)), loans(s, d))),
        "v10_modification": _check(lambda s, d: verify.modification_recomputed(m(s, d, ("modification_rate",)), loans(s, d))),
        "v11_removal": _check(removal),
        "v12_transition_coverage": _check(lambda s, d: verify.transition_coverage(m(s, d, ("delinquency_roll_cure",)), bindings.loans(s, d))),
        "v12_transition_sums": _check(lambda s, d: verify.transition_sums(m(s, d, ("delinquency_roll_cure",)))),
        "v13_new_delinquency": _check(lambda s, d: verify.new_delinquency_matches(m(s, d, ("delinquency_roll_cure", "new_delinquency_redefault")))),
        "v14_cohort_sums": _check(lambda s, d: verify.cohort_sums(m(s, d, ("new_delinquency_redefault",)))),
        "v15_consolidation": _check(_whole_and_parts),
        "v16_unreleased": _check(lambda s, d: verify.unreleased(whole_cube(s, d))),
        "v18_manifests": _check(lambda s, d: population.unreconciled(manifests(s, d).drop("schema_version").unionByName(issued(s, d).drop("source_file").withColumn("source_family", F.lit("issuance"))))),
        "v18_join_totals": _check(lambda s, d: verify.join_totals(population.join_counts(joined(s, d)), loans(s, d))),
        "v19_blank_members": _check(lambda s, d: verify.missing_known(whole_cube(s, d))),
        "v19_mix_reconciles": _check(_mix_reconciles),
        "v21_repeated_keys": _check(lambda s, d: cube.repeated_keys(whole_cube(s, d))),
    }


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "issuance_monthly": monthly,
        "issuance_mix": mix,
        "row_dispositions": lambda s, d: disposed(s, d).groupBy("disposition", "reason").agg(F.count("*").alias("rows")),
        "source_manifest": lambda s, d: population.manifest(disposed(s, d), ["source_file"]),
        "duplicate_keys": duplicates,
        "field_rules": field_rules,
        "scalar_parsing": parsing,
        "formulas": formulas,
        "versions_original": _versions("original"),
        "versions_latest": _versions("latest"),
        "versions_as_of": _versions("latest", "1998-06-15T23:59:59Z"),
        "restatement_lineage": lineage,
        "join_reasons": lambda s, d: population.join_counts(joined(s, d)),
        "period_completeness": completeness,
        "period_differences": set_difference,
        "schema_windows": schema_match,
        "evidence_provenance": provenance,
        "loan_partials": partials,
        "loan_history": states,
        "transition_events": events,
        "latency_percentiles": latency,
        "audit_latest": audit,
        "log_latest": latest_log,
        "leak_scan": leak_scan,
        "payload_series": series,
        "payload_concentration": concentration,
        "payload_findings": findings,
        "payload_evidence": payload_evidence,
        "record_profile": lambda s, d: population.profile(raw_lines(s, d)),
        "family_match": family_match,
        "header_hashes": header_hashes,
        "stale_sources": stale_sources,
        "constant_columns": constant_columns,
        "cube_fingerprint": fingerprint,
        "conformed_securities": conformed_securities,
        "conformed_loans": conformed_loans,
        "conformance_manifest": lambda s, d: conformed(s, d).manifest.select("source_file", "source_family", "report_period", *(f"{n}_count" for n in C.DISPOSITIONS), "quality_status"),
        "conformance_issues": lambda s, d: conformed(s, d).issues.groupBy("code", "detail").agg(F.count("*").alias("rows")),
        "conformance_joins": lambda s, d: conformed(s, d).join_counts,
        "event_windows": event_windows,
        "event_sessions": event_sessions,
        "incremental_loans": incremental_loans,
        "incremental_transitions": incremental_transitions,
        "join_repair": join_repair,
        "streamed_join": streamed_join,
        "streamed_cohorts": streamed_cohorts,
        "committed_parts": committed_parts,
        "partition_totals": partition_totals,
        "leak_sample": leak_sample,
        "resume_scope": resume_scope,
    }
    for contract in verify.CONTRACTS:
        out[f"metric_{contract}"] = lambda s, d, c=contract: as_text(metric(s, d, (c,)))
    return out | checks()


def oracle_sql() -> dict[str, str]:
    out = {
        "issuance_monthly": MONTHLY_SQL,
        "issuance_mix": MIX_SQL,
        "row_dispositions": DISPOSED_SQL + " SELECT disposition, reason, count(*) AS rows FROM dis GROUP BY 1, 2",
        "source_manifest": f"{DISPOSED_SQL} {MANIFEST_SQL}",
        "duplicate_keys": DUPLICATES_SQL,
        "field_rules": FIELD_RULES_SQL,
        "scalar_parsing": PARSING_SQL,
        "formulas": FORMULAS_SQL,
        "versions_original": _versions_sql("original"),
        "versions_latest": _versions_sql("latest"),
        "versions_as_of": _versions_sql("latest", "1998-06-15T23:59:59Z"),
        "restatement_lineage": LINEAGE_SQL,
        "join_reasons": JOINED_SQL + " SELECT report_period, join_reason, count(*) AS row_count FROM jr GROUP BY 1, 2",
        "period_completeness": COMPLETENESS_SQL + " SELECT family, report_period, CAST(n AS BIGINT) AS received FROM x",
        "period_differences": SET_SQL,
        "schema_windows": SCHEMA_MATCH_SQL,
        "evidence_provenance": PROVENANCE_SQL,
        "loan_partials": PARTIALS_SQL,
        "loan_history": STATES_SQL,
        "transition_events": EVENTS_SQL,
        "latency_percentiles": LATENCY_SQL,
        "audit_latest": "SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 50",
        "log_latest": LATEST_LOG_SQL,
        "leak_scan": LEAK_SQL,
        "payload_series": SERIES_SQL,
        "payload_concentration": CONCENTRATION_SQL,
        "payload_findings": FINDINGS_SQL,
        "payload_evidence": _evidence_sql(),
        "record_profile": PROFILE_SQL,
        "family_match": FAMILY_SQL,
        "header_hashes": HEADER_SQL,
        "stale_sources": STALE_SQL,
        "constant_columns": CONSTANT_SQL,
        "cube_fingerprint": FINGERPRINT_SQL,
        "conformed_securities": CONFORMED_SECURITIES_SQL,
        "conformed_loans": CONFORMED_LOANS_SQL,
        "conformance_manifest": f"WITH {CONFORMED_CTE} SELECT source_file, source_family, report_period, " + ", ".join(f"{n}_count" for n in C.DISPOSITIONS) + ", quality_status FROM cm",
        "conformance_issues": f"WITH {CONFORMED_CTE} SELECT CASE WHEN error IS NULL THEN 'DUPLICATE_KEY' ELSE 'INVALID_' || kind || '_ROW' END AS code, coalesce(error, 'duplicate key') AS detail, count(*) AS rows FROM al WHERE disposition <> 'accepted' GROUP BY 1, 2",
        "conformance_joins": f"WITH {CONFORMED_CTE} SELECT period AS report_period, 'monthly-loan-level-1' AS source_family, join_reason, count(*) AS row_count FROM jl GROUP BY 1, 3",
        "event_windows": EVENT_WINDOWS_SQL,
        "event_sessions": EVENT_SESSIONS_SQL,
        "incremental_loans": INCREMENTAL_LOANS_SQL,
        "incremental_transitions": " UNION ALL ".join(f"(SELECT * FROM ({cube_sql.transition_sql(c)}))" for c in ("delinquency_roll_cure", "new_delinquency_redefault")),
        "join_repair": JOINED_SQL + " SELECT report_period, join_reason, count(*) AS row_count FROM jr GROUP BY 1, 2",
        "streamed_join": JOINED_SQL + " SELECT report_period, join_reason, count(*) AS row_count FROM jr GROUP BY 1, 2",
        "streamed_cohorts": f"SELECT * FROM ({cube_sql.transition_sql('new_delinquency_redefault')}) WHERE dimension = 'redefault_trigger' AND correction_view = 'latest'",
        "committed_parts": COMMITTED_SQL,
        "partition_totals": PARTITION_TOTALS_SQL,
        "leak_sample": LEAK_SAMPLE_SQL,
        "resume_scope": f"WITH {CONFORMED_CTE} SELECT DISTINCT coalesce(error, 'duplicate key') AS detail FROM al JOIN cm ON al.file || '.zip' = cm.source_file WHERE disposition <> 'accepted' AND quality_status <> 'pass'",
    }
    for contract in verify.CONTRACTS:
        if contract in ("delinquency_roll_cure", "new_delinquency_redefault"):
            out[f"metric_{contract}"] = cube_sql.transition_sql(contract)
        elif contract == "join_coverage":
            row = cube_sql._row(contract, "x", "n", "sum(n) OVER ()", "n", "(SELECT 'all' AS report_period, join_reason, count(*) AS n FROM jr GROUP BY 2)", dim="join_reason", member="join_reason").replace("'x' AS component", "join_reason AS component")
            out[f"metric_{contract}"] = cube_sql.shaped(row, JOINED_SQL.removeprefix("WITH "))
        elif contract == "source_population_accounting":
            own = f"(SELECT substr(source_file, 4, 7) AS report_period, * FROM ({MANIFEST_SQL}))"
            rows = cube_sql._trust(contract) + [cube_sql._row(contract, f"{d}_count", f"{d}_count", "NULL", "input_count", own, grain="source", dim="source_family", member="'issuance'") for d in C.DISPOSITIONS]
            out[f"metric_{contract}"] = cube_sql.shaped(" UNION ALL ".join(rows), ", ".join([bindings.SECURITY_CTE, cube_sql._MANIFEST, DISPOSED_SQL.removeprefix("WITH ")]))
        elif contract == "file_completeness":
            row = cube_sql._row(contract, "required_package", "n", "1", "n", "x", grain="source", dim="source_family", member="family")
            out[f"metric_{contract}"] = cube_sql.shaped(row, COMPLETENESS_SQL.removeprefix("WITH "))
        else:
            out[f"metric_{contract}"] = cube_sql.contract_sql(contract)
    return out | dict.fromkeys(checks(), NONE_SQL)
