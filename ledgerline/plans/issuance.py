"""Issuance pipeline: raw archives to dispositions, facts, manifest and a payload; fails closed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import population
from ..sources import archives


class ReleaseBlocked(RuntimeError):
    """Evidence is kept, nothing is published."""


#: Header aliases of each target, first match wins.
ALIASES = {
    "security_id": ["Security Identifier"],
    "security_type": ["Prefix"],
    "security_status": ["Security Status Indicator"],
    "issuance_upb": ["Issuance Investor Security UPB"],
    "current_upb": ["Current Investor Security UPB"],
    "security_factor": ["Security Factor"],
    "revision": ["Security Data Correction Indicator"],
}


#: Columns of a delimited source, and the name of each in the facts where it differs.
SAMPLE_REQUIRED = ("report_month", "security_id", "security_type", "issuance_upb", "current_upb", "factor", "cpr_pct", "published_files", "expected_files", "release_lag_days", "revision_flag")
SAMPLE_VERSION = "sample-v1"
_SAMPLE_NAMES = {"factor": "security_factor", "release_lag_days": "publication_lag_days"}


@dataclass
class Batch:
    rows: DataFrame
    manifest: DataFrame
    issues: DataFrame
    facts: DataFrame


def records(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Typed rows from raw lines of usable files; a cell that does not parse rejects its row."""
    heads = archives.headers(lines).select("file", "header")
    usable = files.where("blocker is null").select("file", "report_period", "schema_version")
    body = archives.body(lines).join(heads, "file").join(usable, "file")
    raw = body.select("file", "line", "report_period", "schema_version", "bad_width", *(F.trim(archives.aliased(F.col("cells"), F.col("header"), names)).alias(t) for t, names in ALIASES.items()))
    numbers = ("issuance_upb", "current_upb", "security_factor")
    flags = [(F.col(n) != "") & F.col(n).try_cast("double").isNull() for n in numbers]
    out = raw.withColumn("unparsed", flags[0] | flags[1] | flags[2]).withColumns({n: F.nullif(F.col(n), F.lit("")).try_cast("double") for n in numbers})
    return out.select(
        F.col("report_period").alias("report_month"), "security_id", "security_type", "security_status", *numbers, F.lit(0.0).alias("cpr_pct"), F.lit(1).alias("published_files"), F.lit(1).alias("expected_files"),
        F.lit(0).alias("publication_lag_days"), S.parse_flag(F.col("revision")).alias("revision_flag"), F.col("file").alias("source_file"), F.col("line").alias("source_row"), "schema_version", (F.col("bad_width") | F.col("unparsed")).alias("malformed"),
    )


def delimited(lines: DataFrame, separator: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of delimited files with a header, and the files: file, report_period (or first..last), schema_version, blocker."""
    cells = archives.quoted_cells(F.col("value"), separator, archives.widest(lines, separator))
    heads = lines.where("line = 1").select("file", F.filter(cells, lambda c: c.isNotNull()).alias("header"))
    absent = F.array_except(F.array(*map(F.lit, sorted(SAMPLE_REQUIRED))), "header")
    heads = heads.withColumn("blocker", F.when(F.size(absent) > 0, F.concat(F.lit("missing required columns: "), F.array_join(absent, ", "))))
    body = lines.where("line > 1 and value != ''").select("file", "line", cells.alias("cells")).join(heads, "file")
    cell = lambda n: F.trim(F.coalesce(F.get("cells", F.array_position("header", n).cast("int") - 1), F.lit("")))
    raw = body.where("blocker is null").select("file", "line", *(cell(n).alias(_SAMPLE_NAMES.get(n, n)) for n in SAMPLE_REQUIRED))
    kinds = {"issuance_upb": "double", "current_upb": "double", "security_factor": "double", "cpr_pct": "double", "published_files": "int", "expected_files": "int", "publication_lag_days": "int"}
    unparsed = F.lit(False)
    for n, k in kinds.items():
        unparsed = unparsed | F.col(n).try_cast(k).isNull()
    rows = raw.withColumn("malformed", unparsed).withColumns({n: F.col(n).try_cast(k) for n, k in kinds.items()})
    rows = rows.select(
        "report_month", "security_id", "security_type", F.lit("").alias("security_status"), "issuance_upb", "current_upb", "security_factor", "cpr_pct", "published_files", "expected_files", "publication_lag_days",
        S.parse_flag(F.col("revision_flag")).alias("revision_flag"), F.col("file").alias("source_file"), F.col("line").alias("source_row"), F.lit(SAMPLE_VERSION).alias("schema_version"), "malformed",
    )
    good = rows.where(S.is_month(F.col("report_month"))).groupBy(F.col("source_file").alias("file")).agg(F.min("report_month").alias("low"), F.max("report_month").alias("high"))
    counted = lines.groupBy("file").agg(F.count(F.when((F.col("line") > 1) & (F.col("value") != ""), 1)).alias("n"))
    files = heads.join(counted, "file").join(good, "file", "left")
    period = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.concat("low", F.lit(".."), "high"))
    return rows, files.select("file", period.alias("report_period"), F.lit(SAMPLE_VERSION).alias("schema_version"), F.coalesce("blocker", F.when(F.col("n") == 0, "source contains no data rows")).alias("blocker"))


def load(spark: SparkSession, path: str, contract: Mapping[str, Any], work: str | None = None) -> Batch:
    """Reads every ZIP archive and every CSV (comma) and TXT (pipe) file of the folder ``path``.

    Files that cannot be used appear in the manifest with one rejected input. With ``work``, lines are inflated once,
    into Parquet below it."""
    keep = (lambda f: archives.stored(f, work)) if work else (lambda f: f)
    rows = files = None
    for pattern, separator in (("*.zip", None), ("*.csv", ","), ("*.txt", "|")):
        if separator is None:
            lines = keep(archives.zip_lines(spark, path, pattern=pattern))
            found = keep(archives.inventory(lines, contract))
            own, found = records(lines, found), found.select("file", "report_period", "schema_version", "blocker")
        else:
            own, found = delimited(keep(archives.text_lines(spark, path, pattern)), separator)
        rows = own if rows is None else rows.unionByName(own)
        files = found if files is None else files.unionByName(found)
    rules = (("row does not match the header or holds an invalid value", "not malformed"), ("revision flag must be true/false or 1/0", "revision_flag is not null"), *population.ISSUANCE_RULES)
    disposed = population.dispositions(rows, ["report_month", "security_id"], [F.col("source_file"), F.col("source_row")], rules)
    blocked = files.where("blocker is not null").select(
        F.col("file").alias("source_file"), *(F.lit(n).cast("bigint").alias(f"{d}_count") for d, n in (("input", 1), ("accepted", 0), ("excluded", 0), ("rejected", 1), ("duplicate", 0), ("quarantined", 1))),
        F.lit("fail").alias("quality_status"), F.lit(0).cast("bigint").alias("published_count"),
    )
    periods = files.select(F.col("file").alias("source_file"), "report_period", "schema_version")
    manifest = population.manifest(disposed, ["source_file"]).unionByName(blocked).join(periods, "source_file", "left")
    issues = disposed.where("disposition != 'accepted'").select("source_file", "source_row", F.when(F.col("disposition") == "excluded", "info").otherwise("error").alias("severity"), F.col("reason").alias("message"))
    issues = issues.unionByName(files.where("blocker is not null").select(F.col("file").alias("source_file"), F.lit(None).cast("bigint").alias("source_row"), F.lit("error").alias("severity"), F.concat(F.lit("INVALID_SOURCE: "), "blocker").alias("message")))
    return Batch(disposed, manifest, issues, disposed.where("disposition = 'accepted'").drop("disposition", "reason", "malformed"))


def payload(batch: Batch, groups: Mapping[str, str], unmapped: str) -> dict[str, Any]:
    """The dashboard's JSON: months, mix and metadata. Any failing file blocks it."""
    failing = batch.manifest.where("quality_status = 'fail'").count()
    if failing:
        raise ReleaseBlocked(f"{failing} source files failed")
    months = batch.facts.groupBy(F.col("report_month").alias("month")).agg(
        F.count("*").alias("security_count"), F.sum("issuance_upb").alias("issuance_upb"), F.sum("current_upb").alias("current_upb"), F.avg("security_factor").alias("average_factor"), F.sum("revision_flag").alias("revision_count")
    )
    table = F.create_map(*(F.lit(x) for k, v in groups.items() for x in (k, v)))
    by = batch.facts.groupBy(F.col("report_month").alias("month"), F.coalesce(F.element_at(table, F.col("security_type")), F.lit(unmapped)).alias("product_group")).agg(F.count("*").alias("security_count"), F.sum("issuance_upb").alias("issuance_upb"))
    by = by.join(months.select("month", F.col("issuance_upb").alias("total")), "month").withColumn("issuance_share", S.safe_ratio(F.col("issuance_upb"), F.col("total"))).drop("total")
    month_rows = [r.asDict() for r in months.orderBy("month").collect()]  # one row per month
    mix_rows = [r.asDict() for r in by.orderBy("month", F.col("issuance_upb").desc(), "product_group").collect()]
    evidence = [tuple(r) for r in batch.manifest.orderBy("source_file").collect()]
    sums = {name: [sum(r[c] for r in mix_rows if (r["product_group"] != unmapped) == own) for c in ("security_count", "issuance_upb")] for name, own in (("mapped", True), ("unmapped", False))}
    total = sums["mapped"][1] + sums["unmapped"][1]
    coverage = {f"{name}_{c}": v for name, both in sums.items() for c, v in zip(("observation_count", "issuance_upb"), both)} | {"mapped_issuance_share": sums["mapped"][1] / total if total else 0}
    quality = {"status": "pass", "detail": f"{len(evidence)} source files reconcile"}
    span = {"period_start": month_rows[0]["month"], "period_end": month_rows[-1]["month"]} if month_rows else {}
    metadata = {"build_id": hashlib.sha256(json.dumps(evidence).encode()).hexdigest(), "input_files": len(evidence), "mix": coverage, "quality": quality, **span}
    return {"months": month_rows, "mix": mix_rows, "metadata": metadata}
