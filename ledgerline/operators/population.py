"""Row dispositions, duplicates, versions, lineage and reason-coded joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Fixed values, as are the other reasons below: issuance rules in order; the first that fails names the row's rejection.
ISSUANCE_RULES: tuple[tuple[str, str], ...] = (
    ("report_month must be YYYY-MM", "coalesce(trim(report_month) rlike '^20[0-9]{2}-(0[1-9]|1[0-2])$', false)"),
    ("security identifier is required", "coalesce(trim(security_id), '') != ''"),
    ("security type is required", "coalesce(trim(security_type), '') != ''"),
    ("numeric measures cannot be negative", "least(issuance_upb, current_upb, cpr_pct, published_files, expected_files, publication_lag_days) >= 0"),
    ("balances violate issuance/current UPB constraints", "issuance_upb > 0 and current_upb <= issuance_upb"),
    ("security factor must be greater than 0 and at most 1", "security_factor > 0 and security_factor <= 1"),
    ("CPR percent cannot exceed 100", "cpr_pct <= 100"),
    ("published file count cannot exceed expected file count", "published_files <= expected_files"),
)


#: Tasks that rows of one null or blank key are dealt to.
SPREAD = 1024


def first_failure(rules=ISSUANCE_RULES) -> Column:
    """Message of the first rule that a row breaks; null for a valid row."""
    return F.coalesce(*(F.when(~F.expr(rule), F.lit(message)) for message, rule in rules))


def dispositions(rows: DataFrame, key: list[str], order: list[Column], rules=ISSUANCE_RULES) -> DataFrame:
    """Adds ``disposition`` and ``reason``: excluded (status C without balances), rejected, duplicate of an earlier
    valid row of the same key, or accepted. ``order`` must be total for repeatable results."""
    blank = [F.col(c).isNull() for c in ("issuance_upb", "current_upb", "security_factor")]
    none, some = blank[0] & blank[1] & blank[2], blank[0] | blank[1] | blank[2]
    excluded = none & (F.col("security_status") == "C")
    reason = F.when(excluded, "status-C security without balances").when(some, "issuance UPB, current UPB, and security factor are required together").otherwise(first_failure(rules))
    out = rows.withColumn("reason", reason).withColumn("disposition", F.when(excluded, "excluded").when(F.col("reason").isNotNull(), "rejected").otherwise("valid"))
    # Only valid rows compete for their key; the others, often with blank keys, are spread.
    spread = F.when(F.col("disposition") == "valid", 0).otherwise(1 + F.pmod(F.xxhash64(*order), F.lit(SPREAD)))
    place = F.row_number().over(Window.partitionBy(*key, spread).orderBy(*order))
    again = (F.col("disposition") == "valid") & (place > 1)
    return out.withColumn("again", again).withColumn("reason", F.when(F.col("again"), "duplicate key").otherwise(F.col("reason"))).withColumn("disposition", F.when(F.col("again"), "duplicate").when(F.col("disposition") == "valid", "accepted").otherwise(F.col("disposition"))).drop("again")


def manifest(disposed: DataFrame, by: list[str]) -> DataFrame:
    """Counts of each disposition and the file's verdict: one rejected or duplicate row fails it, nothing is published then."""
    n = lambda d: F.count(F.when(F.col("disposition") == d, 1)).alias(f"{d}_count")
    out = disposed.groupBy(*by).agg(F.count("*").alias("input_count"), n("accepted"), n("excluded"), n("rejected"), n("duplicate"))
    out = out.withColumn("quarantined_count", F.col("rejected_count") + F.col("duplicate_count"))
    out = out.withColumn("quality_status", F.when(F.col("quarantined_count") > 0, "fail").otherwise("pass"))
    return out.withColumn("published_count", F.when(F.col("quality_status") == "pass", F.col("accepted_count")).otherwise(F.lit(0)))


def unreconciled(manifests: DataFrame) -> DataFrame:
    """Manifests whose counts do not add up; none, if all is well."""
    return manifests.where("input_count != accepted_count + excluded_count + rejected_count + duplicate_count or quarantined_count != rejected_count + duplicate_count")


def duplicates(rows: DataFrame, key: list[str], order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows to keep, the first of each key; and the number of further rows of each key that has some."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("place", place).where("place = 1").drop("place"), rows.groupBy(*key).agg((F.count("*") - 1).alias("duplicates")).where("duplicates > 0")


# ---- versions

VERSION_ORDER = ("as_of_timestamp", "publication_date", "source_id")


def version_view(facts: DataFrame, key: list[str], view: str, as_of: str | None = None) -> DataFrame:
    """The first (``original``) or last (``latest``) version of each key from passing sources, up to ``as_of`` if given."""
    passing = facts.where("quality_status = 'pass'") if "quality_status" in facts.columns else facts
    passing = passing.where(F.col("as_of_timestamp") <= as_of) if as_of else passing
    order = [F.col(c).asc() if view == "original" else F.col(c).desc() for c in VERSION_ORDER]
    partition = [F.coalesce(F.col(c), F.lit("")) if c == "security_id" else F.col(c) for c in key]
    return passing.withColumn("place", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).where("place = 1").drop("place")


def lineage(facts: DataFrame, key: list[str]) -> DataFrame:
    """Each version after the first of its key: the source it replaces, and whether its record changed."""
    order = Window.partitionBy(*key).orderBy("as_of_timestamp", "source_id")
    out = facts.withColumn("prior_source_id", F.lag("source_id").over(order)).withColumn("prior_hash", F.lag("record_hash").over(order))
    return out.where("prior_source_id is not null").select(*key, "prior_source_id", F.col("source_id").alias("replacement_source_id"), (F.col("prior_hash") != F.col("record_hash")).alias("changed"))


# ---- joins

JOIN_REASONS = ("terminated", "ineligible", "ambiguous", "matched", "late", "unmatched")


def join_reason(loans: DataFrame, securities: DataFrame) -> DataFrame:
    """``loans`` plus ``join_reason``: what became of the join to the securities of the same period.

    Termination (a deleted loan, or any version of the security in status P, C or D) comes before ineligible
    (no id), ambiguous (several versions), matched, late (the id appears in a later period) and unmatched."""
    index = securities.where("security_id is not null").groupBy("security_id", "report_period").agg(F.count("*").alias("matches"), F.max(F.col("security_status").isin("P", "C", "D").cast("int")).alias("ended"))
    # One row for each id with a map of its months, so that loans are shuffled once.
    by_id = index.groupBy("security_id").agg(F.map_from_entries(F.collect_list(F.struct("report_period", F.struct("matches", "ended")))).alias("months"), F.max("report_period").alias("last_period"))
    by_id = by_id.select(F.col("security_id").alias("of"), F.pmod(F.xxhash64("security_id"), F.lit(1)).alias("none"), "months", "last_period")
    # Loans without an id match nothing, so they need not meet in one task.
    names = [c for c in ("loan_id", "source_row") if c in loans.columns] or loans.columns  # hashing few columns keeps the scan pruned
    none = F.when(F.col("security_id").isNull(), 1 + F.pmod(F.xxhash64(*names), F.lit(SPREAD))).otherwise(0)
    # Ids come first: what is joined is sorted by the leading bytes of its first key, and nearly all rows are dealt alike.
    out = loans.withColumn("deal", none).join(by_id, (F.col("security_id") == F.col("of")) & (F.col("deal") == F.col("none")), "left")
    out = out.withColumn("month", F.col("months")[F.col("report_period")])
    n = F.coalesce("month.matches", F.lit(0))
    reason = (
        F.when((F.col("correction_indicator") == "D") | (F.coalesce("month.ended", F.lit(0)) == 1), "terminated").when(F.col("security_id").isNull(), "ineligible")
        .when(n > 1, "ambiguous").when(n == 1, "matched").when(F.col("last_period") > F.col("report_period"), "late").otherwise("unmatched")
    )
    return out.withColumn("join_reason", reason).select(*loans.columns, "join_reason")


def join_counts(joined: DataFrame, by: tuple[str, ...] = ("report_period",)) -> DataFrame:
    return joined.groupBy(*by, "join_reason").agg(F.count("*").alias("row_count"))


def month_spine(windows: DataFrame) -> DataFrame:
    """(family, report_period) for every month of every schema window (family, period_min, period_max), once."""
    months = F.sequence(F.to_date(F.concat("period_min", F.lit("-01"))), F.to_date(F.concat("period_max", F.lit("-01"))), F.expr("interval 1 month"))
    return windows.select("family", F.explode(months).alias("m")).select("family", F.date_format("m", "yyyy-MM").alias("report_period")).distinct()


def completeness(windows: DataFrame, received: DataFrame) -> DataFrame:
    """Expected months with the number of packages received, zero included. ``received``: family, report_period."""
    counts = received.groupBy("family", "report_period").agg(F.count("*").alias("received"))
    return month_spine(windows).join(counts, ["family", "report_period"], "left").withColumn("received", F.coalesce("received", F.lit(0)))


def schema_version(files: DataFrame, windows: DataFrame) -> DataFrame:
    """The one schema window of each file (family, report_period), and how many fit: any other number is an error."""
    f, w = files.alias("f"), windows.alias("w")
    inside = (F.col("f.family") == F.col("w.family")) & F.col("f.report_period").between(F.coalesce("w.period_min", F.lit("")), F.coalesce("w.period_max", F.lit("9999-99")))
    return f.join(w, inside, "left").groupBy(*(F.col(f"f.{c}") for c in files.columns)).agg(F.count("w.schema_version").alias("fits"), F.min("w.schema_version").alias("schema_version"))


def header_hash(columns: Column, separator: str = "|") -> Column:
    return F.sha2(F.concat_ws(separator, columns), 256)


def provenance(evidence: DataFrame, sources: DataFrame, on: list[str]) -> DataFrame:
    """``evidence`` with the sorted sources of its key as an array of structs."""
    listed = sources.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(*(c for c in sources.columns if c not in on)))).alias("sources"))
    return evidence.join(listed, on, "left")


def profile(lines: DataFrame, separator: str = r"\|") -> DataFrame:
    """Record types and widths of raw lines (file, value), counted; no values leave."""
    cells = F.split("value", separator, -1)
    return lines.groupBy("file", F.get(cells, F.lit(0)).alias("record_type"), F.size(cells).alias("width")).agg(F.count("*").alias("rows"))


