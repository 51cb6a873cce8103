"""The engine's facts drawn from the test tables: orders act as securities, line items as loans.

Expressions are plain SQL, read by Spark here and by the SQL that the results are held against. ``{ym:x}`` and
``{ymd:x}`` stand for a timestamp's month and day as text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import contracts
from . import release
from .parts import workspace

SECURITY = {
    "security_id": "concat('S', cast(o_custkey % 300 as string))",
    "join_security_id": "case when o_orderkey % 3 = 0 and o_orderkey % 5 <> 0 then concat('J', cast(o_custkey % 300 as string)) else concat('S', cast(o_custkey % 300 as string)) end",
    "report_period": "{ym:o_orderdate}",
    "package_family": "case when o_orderkey % 4 = 0 then case when o_orderkey % 3 = 0 then 'supers' else 'pools' end else 'others' end",
    "package_period": "{ym:o_orderdate}",
    "source_id": "o_orderkey",
    "source_family": "case when o_orderkey % 3 = 0 then 'supers' else 'pools' end",
    "as_of_timestamp": "concat({ymd:o_orderdate}, 'T23:59:59Z')",
    "publication_date": "{ymd:o_orderdate}",
    "quality_status": "case when o_orderkey % 50 = 0 then 'fail' else 'pass' end",
    "security_status": "case o_orderstatus when 'P' then 'P' else 'A' end",
    "correction_indicator": "case when o_orderkey % 20 = 0 then 'D' when o_orderkey % 7 = 0 then 'C' else 'N' end",
    "current_upb_cents": "case when o_orderkey % 23 = 0 then null else cast(round(o_totalprice * 100) as bigint) end",
    "issuance_cents": "cast(round(o_totalprice * 100) as bigint)",
    "loan_count": "case when o_orderkey % 1009 = 0 then null else o_orderkey % 97 end",
    "factor_e8": "case when o_orderkey % 29 = 0 then null else 50000000 + (o_orderkey * 7919) % 50000000 end",
    "prefix": "case substr(o_orderpriority, 1, 1) when '1' then 'CL' when '2' then 'CI' when '3' then 'ZL' when '4' then 'QQ' else 'CT' end",
    "legacy_credit_score": "case when o_orderkey % 13 = 0 then null when o_orderkey % 31 = 0 then -1 else 600 + o_orderkey % 200 end",
    "classic_fico": "case when o_orderkey % 5 = 0 then null else 550 + o_orderkey % 300 end",
    "vs4": "case when o_orderkey % 3 = 0 then null else 500 + o_orderkey % 350 end",
    "involuntary_removal_count": "case when o_orderkey % 2003 = 0 then null else o_orderkey % 9 - 1 end",
    "involuntary_removal_upb_cents": "case when o_orderkey % 3001 = 0 then null else o_orderkey % 100000 - 500 end",
    "wa_net_interest_rate_milli_pct": "o_orderkey % 9000",
    "wa_issuance_interest_rate_milli_pct": "case when o_orderkey % 17 = 0 then null else o_orderkey % 8000 end",
    "wa_current_interest_rate_milli_pct": "o_orderkey % 7000 - 10",
    "wa_ltv_pct": "o_orderkey % 98",
    "wa_cltv_pct": "o_orderkey % 110",
    "wa_eltv_pct": "case when o_orderkey % 19 = 0 then null else o_orderkey % 90 end",
    "wa_dti_pct": "o_orderkey % 51",
    "mission_density_score_centi": "case when o_orderkey % 11 = 0 then null else o_orderkey % 4 * 50 end",
    "mission_criteria_share_centi_pct": "case when o_orderkey % 12 = 0 then null else o_orderkey % 5 * 2525 end",
    "green_indicator": "case o_orderkey % 3 when 0 then 'Y' when 1 then 'N' else '' end",
    "social_indicator": "case o_orderkey % 4 when 0 then 'Y' when 1 then 'N' else null end",
    "mission_index_version": "case when o_orderkey % 2 = 0 then 'v1' else 'v2' end",
    "schema_version": "case when {ym:o_orderdate} < '1998-06' then 'v1' when o_orderkey % 2 = 0 then 'v2' else 'v3' end",
}

LOAN = {
    "loan_id": "concat('L', cast(o_custkey % 300 as string))",
    "security_id": "case when l_orderkey % 43 = 0 then null else concat('S', cast(o_custkey % 300 as string)) end",
    "report_period": "{ym:o_orderdate}",
    "source_family": "case when o_custkey % 3 = 0 then 'supers' else 'pools' end",
    "source_file": "concat('F', cast(l_orderkey % 4 as string))",
    "source_row": "((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey % 100000) * 1000 + l_suppkey % 1000",
    "as_of_timestamp": "concat({ymd:o_orderdate}, 'T23:59:59Z')",
    "publication_date": "{ymd:l_shipdate}",
    "join_reason": "case when l_orderkey % 11 = 0 then 'unmatched' else 'matched' end",
    "correction_indicator": "case when l_partkey % 20 = 0 then 'D' when l_partkey % 7 = 0 then 'C' else 'N' end",
    "current_upb_cents": "case when l_orderkey % 37 = 0 then null when l_orderkey % 41 = 0 then 0 else cast(round(l_extendedprice * 100) as bigint) end",
    "current_deferred_upb_cents": "case when l_partkey % 3 = 0 then null when l_partkey % 31 = 0 then -5 else l_partkey % 500 end",
    "days_delinquent": "case when l_partkey % 19 = 0 then null when l_linenumber <= 4 then 0 else l_partkey % 120 end",
    "loan_age": "l_partkey % 360",
    "remaining_months_to_maturity": "360 - l_partkey % 360",
    "legacy_credit_score": "case when l_partkey % 6 = 0 then null when l_partkey % 35 = 0 then -1 else 600 + l_partkey % 20 end",
    "classic_fico": "case when l_partkey % 5 = 0 then null else 620 + l_partkey % 20 end",
    "vs4": "case when l_partkey % 4 = 0 then null else 640 + l_partkey % 20 end",
    "updated_legacy_credit_score": "660 + l_partkey % 20",
    "updated_classic_fico": "case when l_suppkey % 5 = 0 then null else 680 + l_partkey % 20 end",
    "updated_vs4": "case when l_suppkey % 2 = 0 then null else 700 + l_partkey % 20 end",
    "original_interest_rate_milli_pct": "cast(round(l_discount * 100000) as bigint)",
    "issuance_interest_rate_milli_pct": "cast(round(l_tax * 100000) as bigint)",
    "current_interest_rate_milli_pct": "case when l_linenumber = 7 then null else cast(round(l_discount * 90000) as bigint) end",
    "issuance_net_interest_rate_milli_pct": "cast(round(l_tax * 90000) as bigint) - 20",
    "current_net_interest_rate_milli_pct": "cast(round(l_discount * 80000) as bigint)",
    "ltv_pct": "case when l_partkey % 14 = 0 then null else cast(l_quantity as bigint) + 50 end",
    "cltv_pct": "cast(l_quantity as bigint) + 60",
    "eltv_pct": "cast(l_quantity as bigint) + 40",
    "dti_pct": "cast(l_quantity as bigint)",
    "first_time_homebuyer": "l_returnflag",
    "loan_purpose": "l_linestatus",
    "occupancy_status": "case l_linenumber % 3 when 0 then 'P' when 1 then ' I ' else '' end",
    "number_of_units": "cast(l_linenumber % 4 + 1 as string)",
    "property_type": "case l_suppkey % 4 when 0 then 'SF' when 1 then 'CO' when 2 then 'PU' else null end",
    "channel": "case l_partkey % 3 when 0 then 'R' when 1 then 'B' else 'C' end",
    "government_insured_guarantee": "case when l_partkey % 8 = 0 then 'FHA' when l_partkey % 8 = 1 then 'VA' else ' ' end",
    "alternative_resolution": "case when l_partkey % 10 = 0 then 'D' else '' end",
    "borrower_assistance_plan": "case when l_partkey % 15 = 0 then 'F' when l_partkey % 15 = 1 then 'R' else null end",
    "special_eligibility_program": "case when l_suppkey % 6 = 0 then 'H' else '9' end",
    "prefix": "case l_suppkey % 5 when 0 then 'CL' when 1 then 'CI' when 2 then 'ZL' when 3 then 'QQ' else 'CT' end",
    "property_state": "concat('N', cast(l_suppkey % 25 as string))",
    "seller_name": "case when l_partkey % 26 = 25 then '' else concat('Brand#', cast(l_partkey % 26 as string)) end",
    "servicer_name": "concat('Supplier#', cast(l_suppkey % 40 as string))",
    "modification_program": "case when l_partkey % 9 = 0 then 'MOD' else ' ' end",
    "mortgage_insurance_pct": "case when l_partkey % 16 = 0 then null when l_partkey % 4 = 1 then 25 else 0 end",
    "mortgage_insurance_cancellation": "case when l_partkey % 5 = 0 then 'Y' else 'N' end",
}

#: Monthly archives as lines, one file a month; every third and seventh month holds rows that fail a check.
_ODD = "substr({ym:o_orderdate}, 6, 2) in ('03', '07')"
SECURITY_LINES = {
    "file": "concat('fd', substr({ym:o_orderdate}, 3, 2), substr({ym:o_orderdate}, 6, 2), '07')",
    "row_key": "o_orderkey",
    "Prefix": "case o_orderkey % 4 when 0 then 'CL' when 1 then 'MA' when 2 then '1A' else 'CI' end",
    "Security Identifier": f"case when {_ODD} and o_orderkey % 11 = 0 then ' ' when {_ODD} and o_orderkey % 13 = 0 then 'SAME' else concat('S', cast(o_orderkey as string)) end",
    "Security Factor Date": f"case when {_ODD} and o_orderkey % 17 = 0 then '131999' else concat(substr({{ym:o_orderdate}}, 6, 2), '20', substr({{ym:o_orderdate}}, 3, 2)) end",
    "Security Factor": f"case when {_ODD} and o_orderkey % 19 = 0 then 'x' when o_orderkey % 3 = 0 then '' else '.5' end",
    "Security Data Correction Indicator": f"case when {_ODD} and o_orderkey % 23 = 0 then '?' when o_orderkey % 5 = 0 then 'Y' else 'N' end",
    "Security Status Indicator": "case o_orderstatus when 'P' then 'P' else 'A' end",
    "Current Investor Security UPB": "concat(cast(o_orderkey as string), '.25')",
    "Issue Date": f"case when {_ODD} and o_orderkey % 29 = 0 then '01022025' when o_orderkey % 2 = 0 then '01012025' else '' end",
    "Green Indicator": "case o_orderkey % 3 when 0 then 'Y' when 1 then '9' else ' ' end",
}
LOAN_LINES = {
    "file": "concat('fu', substr({ym:o_orderdate}, 3, 2), substr({ym:o_orderdate}, 6, 2), '07')",
    "row_key": "((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey % 100000) * 1000 + l_suppkey % 1000",
    "Loan Identifier": "concat('L', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string))",
    "Loan Correction Indicator": f"case when {_ODD} and l_partkey % 31 = 0 then 'Z' when l_partkey % 20 = 0 then 'D' else 'N' end",
    "Prefix": "'CL'",
    "Security Identifier": "case when l_partkey % 43 = 0 then '' when l_partkey % 41 = 0 then 'NONE' else concat('S', cast(l_orderkey as string)) end",
    "Current Investor Loan UPB": "cast(l_partkey as string)",
    "Days Delinquent": "case when l_linenumber = 1 then '' else cast(l_partkey % 120 as string) end",
}

#: Product groups of prefixes; any other prefix is unmapped.
PRODUCT_GROUPS = {"CL": "30-year UMBS / Supers family", "ZL": "30-year UMBS / Supers family", "CT": "20-year UMBS / Supers family", "CI": "15-year UMBS / Supers family"}
UNMAPPED = "Other / Unmapped prefix"

ISSUANCE = {
    "report_month": "case when o_orderkey % 997 = 0 then '98-1' else {ym:o_orderdate} end",
    "security_id": "case when o_orderkey % 499 = 0 then ' ' else concat('S', cast(o_orderkey % 14000 as string)) end",
    "security_type": "substr(o_orderpriority, 1, 1)",
    "security_status": "case when o_orderkey % 61 = 0 then 'C' else 'A' end",
    "issuance_upb": "case when o_orderkey % 61 = 0 or o_orderkey % 89 = 0 then null else o_totalprice end",
    "current_upb": "case when o_orderkey % 61 = 0 then null when o_orderkey % 101 = 0 then o_totalprice * 2 else o_totalprice * 0.5 end",
    "security_factor": "case when o_orderkey % 61 = 0 then null when o_orderkey % 103 = 0 then 1.5 else 0.5 end",
    "cpr_pct": "case when o_orderkey % 107 = 0 then 101 else o_orderkey % 30 end",
    "published_files": "case when o_orderkey % 109 = 0 then 3 else 1 end",
    "expected_files": "2",
    "publication_lag_days": "case when o_orderkey % 113 = 0 then -1 else 2 end",
    "revision_flag": "cast(o_orderkey % 7 = 0 as int)",
    "source_file": "concat('IS_', {ym:o_orderdate})",
    "source_row": "o_orderkey",
}


def spark_sql(text: str) -> str:
    return re.sub(r"\{ymd:(\w+)\}", r"date_format(\1, 'yyyy-MM-dd')", re.sub(r"\{ym:(\w+)\}", r"date_format(\1, 'yyyy-MM')", text))


def other_sql(text: str) -> str:
    out = re.sub(r"\{ymd:(\w+)\}", r"strftime(\1, '%Y-%m-%d')", re.sub(r"\{ym:(\w+)\}", r"strftime(\1, '%Y-%m')", text))
    return out.replace(" as string)", " as varchar)")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*(F.expr(spark_sql(e)).alias(n) for n, e in columns.items()))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "orders"), SECURITY)


def _loan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Orders of a task are hashed: line items need no sort, which would spill, and cost the same a row at every size.
    return lines.join(orders.hint("shuffle_hash"), lines["l_orderkey"] == orders["o_orderkey"])


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_loan_rows(spark, sf_dir), LOAN)


def kept_loans(spark: SparkSession, sf_dir: str, folder: str, columns: tuple[str, ...] = tuple(LOAN)) -> DataFrame:
    """``columns`` of the loans for what reads them several times: line items meet their orders once, and what the loans
    are drawn from is written below ``folder``; loans are as cheap as a scan then."""
    rows = _loan_rows(spark, sf_dir)
    wanted = {c: LOAN[c] for c in columns}
    needed = [c for c in rows.columns if any(re.search(rf"\b{c}\b", e) for e in wanted.values())]
    return _select(release.staged(rows.select(*needed), folder), wanted)


def issuance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "orders"), ISSUANCE)


def _cte(name: str, columns: dict[str, str], source: str) -> str:
    return f"{name} AS (SELECT " + ", ".join(f'{other_sql(e)} AS "{n}"' for n, e in columns.items()) + f" FROM {source})"


#: Rows of all files that are numbered in one task.
SLICE = 1_000_000


def archive_lines(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The monthly archives of securities and loans as ``zip_lines`` gives them: file, member, line, value, error.

    Rows are numbered in slices of their key and stored below ``folder``; the rows of a file's slices before are few sums,
    which are added where lines are read. So no task sorts a file, however long it is."""
    folder, orders = folder or f"{workspace(spark)}/lines", _table(spark, sf_dir, "orders")
    both = lambda: _table(spark, sf_dir, "lineitem").join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    count, last = orders.agg(F.count("*"), F.max("o_orderkey")).first()
    slices = 1 + 5 * count // SLICE  # of about five rows an order
    out = None
    for source, columns, order in ((orders, SECURITY_LINES, "o_orderkey"), (both(), LOAN_LINES, "l_orderkey")):
        names = [c for c in columns if c not in ("file", "row_key")]
        # A slice holds the keys of a range of orders, and row keys ascend with them.
        part = F.floor(F.col(order) * F.lit(slices).cast("decimal(20,0)") / F.lit((last or 0) + 1)).cast("int").alias("slice")
        # A row's month is made once; rows are dealt as numbers, which are shorter than the text that is made of them.
        own_sql = {n: spark_sql(e.replace("{ym:o_orderdate}", "month")) for n, e in columns.items()}
        needed = [c for c in source.columns if any(re.search(rf"\b{c}\b", e) for e in own_sql.values())]
        dated = source.select(*needed, F.expr(spark_sql("{ym:o_orderdate}")).alias("month"), part)
        dealt = dated.select("*", F.expr(own_sql["file"]).alias("file")).repartition("file", "slice")
        rows = dealt.select("file", "slice", *(F.expr(e).alias(n) for n, e in own_sql.items() if n != "file"))
        own = Window.partitionBy("file", "slice").orderBy("row_key", "value")
        body = rows.select("file", "row_key", "slice", F.concat_ws("|", *(F.col(f"`{n}`") for n in names)).alias("value")).withColumn("own", F.row_number().over(own).cast("long"))
        with release.compiled(spark):
            kept = release.staged(body.select("file", "slice", "own", "value"), folder)
        before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = kept.groupBy("file", "slice").agg(F.count("*").alias("n")).select(F.col("file").alias("of"), F.col("slice").alias("at"), before.alias("before"))
        counts = release.staged(counts, folder)
        placed = kept.join(F.broadcast(counts), (F.col("file") == F.col("of")) & (F.col("slice") == F.col("at"))).select("file", (F.col("before") + F.col("own") + 1).alias("line"), "value")
        # A file's first slice has none before it, and stands for its header.
        head = counts.where("before = 0").select(F.col("of").alias("file"), F.lit(1).cast("long").alias("line"), F.lit("|".join(names)).alias("value"))
        own = placed.unionByName(head).select(F.concat("file", F.lit(".zip")).alias("file"), F.concat("file", F.lit(".txt")).alias("member"), "line", "value", F.lit(None).cast("string").alias("error"))
        out = own if out is None else out.unionByName(own)
    return out


def archive_contract() -> dict:
    """The contract of these archives, and the header names of its targets by kind."""

    def family(i: str, start: str, columns: dict) -> dict:
        header = [c for c in columns if c not in ("file", "row_key")]
        version = {"version": "v1", "header_sha256": contracts.header_sha256(header), "column_count": len(header)}
        return {"id": i, "pattern": rf"^{start}(?P<year>\d{{2}})(?P<month>\d{{2}})\d{{2}}\.zip$", "schema_versions": [version]}

    return {"families": [family("monthly-security-core-1", "fd", SECURITY_LINES), family("monthly-loan-level-1", "fu", LOAN_LINES)]}


ARCHIVE_ALIASES = {
    "security": {
        "prefix": ["Prefix"], "security_id": ["Security Identifier"], "security_factor_date": ["Security Factor Date"], "security_factor": ["Security Factor"], "security_correction_indicator": ["Security Data Correction Indicator"],
        "security_status": ["Security Status Indicator"], "current_security_upb": ["Current Investor Security UPB"], "issue_date": ["Issue Date"], "green_indicator": ["Green Indicator"],
    },
    "loan": {
        "loan_id": ["Loan Identifier"], "loan_correction_indicator": ["Loan Correction Indicator"], "prefix": ["Prefix"], "security_id": ["Security Identifier"], "current_loan_upb": ["Current Investor Loan UPB"], "days_delinquent": ["Days Delinquent"],
    },
}


SECURITY_CTE = _cte("sec", SECURITY, "orders")
SECURITY_LINES_CTE = _cte("fd", SECURITY_LINES, "orders")
LOAN_LINES_CTE = _cte("fu", LOAN_LINES, "lineitem JOIN orders ON l_orderkey = o_orderkey")
LOAN_CTE = _cte("loan", LOAN, "lineitem JOIN orders ON l_orderkey = o_orderkey")
ISSUANCE_CTE = _cte("iss", ISSUANCE, "orders")


def product_group(prefix: str = "prefix"):
    table = F.create_map(*(F.lit(x) for k, v in PRODUCT_GROUPS.items() for x in (k, v)))
    return F.coalesce(F.element_at(table, F.col(prefix)), F.lit(UNMAPPED))


PRODUCT_GROUP_SQL = "CASE prefix " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRODUCT_GROUPS.items()) + f" ELSE '{UNMAPPED}' END"
