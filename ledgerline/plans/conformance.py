"""Conformance: raw archive lines to typed facts, with a reason for every rejected row.

Lines of usable files become one typed row each; the first check that a row fails names its rejection. Of the rows
that pass, the first of each business key is accepted, later ones are duplicates. A source with one rejected or
duplicate row fails as a whole: its manifest says so and none of its rows are published. Published loans join
published securities with a reason."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import fields, population
from ..sources import archives, provider_rules
from . import release
from .parts import Parts, digests

#: Target of the contract -> column, decimals kept (None: integer) and the name used in messages.
SECURITY_NUMBERS = (
    ("issuance_security_upb", "issuance_upb_cents", 2, "Issuance Investor Security UPB"), ("current_security_upb", "current_upb_cents", 2, "Current Investor Security UPB"), ("security_factor", "factor_e8", 8, "Security Factor"),
    ("loan_count", "loan_count", None, "Loan Count"), ("legacy_credit_score", "legacy_credit_score", None, "legacy credit score"), ("classic_fico", "classic_fico", None, "Classic FICO"), ("vs4", "vs4", None, "VS4"),
    ("involuntary_removal_upb", "involuntary_removal_upb_cents", 2, "Involuntary Loan Removal UPB"), ("involuntary_removal_count", "involuntary_removal_count", None, "Involuntary Loan Removal count"),
)
LOAN_NUMBERS = (
    ("mortgage_loan_amount", "mortgage_loan_amount_cents", 2, "Mortgage Loan Amount"), ("issuance_loan_upb", "issuance_upb_cents", 2, "Issuance Investor Loan UPB"), ("current_loan_upb", "current_upb_cents", 2, "Current Investor Loan UPB"),
    ("remaining_months_to_maturity", "remaining_months_to_maturity", None, "Remaining Months to Maturity"), ("loan_age", "loan_age", None, "Loan Age"), ("legacy_credit_score", "legacy_credit_score", None, "legacy credit score"),
    ("classic_fico", "classic_fico", None, "Classic FICO"), ("vs4", "vs4", None, "VS4"), ("updated_legacy_credit_score", "updated_legacy_credit_score", None, "updated legacy credit score"),
    ("updated_classic_fico", "updated_classic_fico", None, "Updated Classic FICO"), ("updated_vs4", "updated_vs4", None, "Updated VS4"), ("days_delinquent", "days_delinquent", None, "Days Delinquent"),
    ("current_deferred_upb", "current_deferred_upb_cents", 2, "Current Deferred UPB"),
)
LOAN_TEXTS = ("modification_program", "property_state", "seller_name", "servicer_name")
#: Stored names of rule-checked fields where they differ from the target.
_STORED = {"mission_density_score": "mission_density_score_centi", "mission_criteria_share": "mission_criteria_share_centi_pct", "mortgage_insurance_percent": "mortgage_insurance_pct"}


def stored_name(rule: Mapping[str, Any]) -> str:
    """The column of a rule-checked field: rates in thousandths, amounts in cents, ratios in percent."""
    name = rule["target"]
    if name in _STORED:
        return _STORED[name]
    if rule["type"] == "decimal":
        return name + ("_milli_pct" if rule["scale"] == 3 else "_cents")
    return name + ("_pct" if name.removeprefix("wa_") in ("ltv", "cltv", "eltv", "dti") else "")


@dataclass(frozen=True, eq=False)
class Kind:
    """What conforming needs to know of a family; codes and messages are fixed values."""

    name: str
    prefix: str  # of family ids
    required: tuple[str, ...]
    correction: str
    corrections: tuple[str, ...]
    numbers: tuple
    texts: tuple[str, ...]
    rules: tuple
    key: tuple[str, ...]
    label: str


SECURITY = Kind("security", "monthly-security-core", ("prefix", "security_id", "security_factor_date", "security_correction_indicator", "security_status"), "security_correction_indicator", ("Y", "N"), SECURITY_NUMBERS, (), provider_rules.SECURITY_RULES, ("report_period", "security_id"), "Security Data Correction Indicator")
LOAN = Kind("loan", "monthly-loan-level", ("loan_id", "loan_correction_indicator", "prefix", "security_id"), "loan_correction_indicator", ("Y", "N", "A", "D"), LOAN_NUMBERS, LOAN_TEXTS, provider_rules.LOAN_RULES, ("report_period", "loan_id", "security_id"), "Loan Correction Indicator")
SECURITY_STATUSES = ("A", "P", "C", "D")
#: What the join reads of either kind.
JOINING = ("security_status", "correction_indicator")
LINEAGE = ("source_file", "source_row", "source_family", "schema_version", "publication_date", "as_of_timestamp")
#: Of these, what is the same for all rows of a file and needs no place in stored facts: manifests have it.
OF_FILE = ("schema_version", "publication_date", "as_of_timestamp")


def known_targets(kind: Kind, aliases: Mapping[str, list[str]]) -> list[str]:
    """The targets of a kind that the contract has names for, in order."""
    return list(dict.fromkeys(t for t in [*kind.required, *(t for t, *_ in kind.numbers), *kind.texts, *(r["target"] for r in kind.rules)] if t in aliases))


#: Rows that are broadcast at most: of files, of keys that occur again, of duplicates.
FEW = 100_000


def few(frame: DataFrame) -> bool:
    return frame.limit(FEW + 1).count() <= FEW


def raw_rows(lines: DataFrame, files: DataFrame, kind: Kind, aliases: Mapping[str, list[str]], keep=lambda frame: frame, heads: DataFrame | None = None) -> DataFrame:
    """Lines with text of the usable files of one kind, with their cells, their file's width and lineage, and ``at``: for each
    of ``known_targets`` the place of its cell, found once for a file (-1 if the header has none of its names).

    What is known of files comes to the lines, which stay where they are, unless there are too many files for that.
    ``heads``: ``archives.headers`` of the lines, if they are stored."""
    published = S.publication_date(F.col("member"))
    place = lambda t: F.coalesce(*(F.nullif(F.array_position("header", n), F.lit(0)) for n in aliases[t]), F.lit(0)).cast("int") - 1
    heads = archives.headers(lines) if heads is None else heads
    heads = heads.select("file", F.size("header").alias("width"), F.array(*map(place, known_targets(kind, aliases))).cast("array<int>").alias("at"), published.alias("publication_date"), S.as_of_timestamp(published).alias("as_of_timestamp"))
    usable = keep(files.where("blocker is null").where(F.col("family").startswith(kind.prefix)).select("file", "family", "report_period", "schema_version").join(heads, "file"))
    body = lines.where("line > 1").where(F.trim("value") != "")
    out = body.join(F.broadcast(usable) if few(usable) else usable, "file").withColumn("cells", archives.cells(F.col("value")))
    return out.select(F.col("file").alias("source_file"), F.col("line").alias("source_row"), F.col("family").alias("source_family"), "schema_version", "publication_date", "as_of_timestamp", "report_period", "cells", "width", "at")


def typed(rows: DataFrame, kind: Kind, aliases: Mapping[str, list[str]], with_rules: bool = True) -> DataFrame:
    """Facts of ``raw_rows`` with ``error``: the message of the first check that the row fails, null for a sound one.

    ``aliases``: target -> header names, first match wins. Without rules their columns are null.

    Cells, their trimmed text, what of them is sound and the rules' results are top-level columns of projections of their own:
    fields of a struct would be put in place of each of their uses, and computed again there. Rules of cells that no header
    has are known but for the row's class and cost no more than a letter."""
    known = known_targets(kind, aliases)
    at = {t: F.get("at", F.lit(i)) for i, t in enumerate(known)}
    cell = lambda t: F.col(f"cell_{t}") if t in known else F.lit("")
    text = lambda t: F.col(f"text_{t}") if t in known else F.lit("")
    raw = rows.select(*LINEAGE, "report_period", (F.size("cells") != F.col("width")).alias("bad_width"), *(F.when(at[t] < 0, "").otherwise(F.get("cells", at[t])).alias(f"cell_{t}") for t in known), "at")
    raw = raw.select("*", *(F.trim(cell(t)).alias(f"text_{t}") for t in known))
    absent = F.lit(False)
    for t in kind.required:
        absent = absent | (at[t] < 0 if t in known else F.lit(True))
    sound = {target: (S.is_integer(text(target)) if scale is None else S.is_scaled(text(target), scale)) if target in known else F.lit(True) for target, _, scale, _ in kind.numbers}
    correction = text(kind.correction)
    raw = raw.withColumns({f"sound_{t}": c for t, c in sound.items() if t in known} | {"row_class": provider_rules.row_class(text("prefix")), "bad_context": ~F.coalesce(correction.isin(*kind.corrections), F.lit(False))})
    sound = {t: F.col(f"sound_{t}") if t in known else c for t, c in sound.items()}
    own = "security" if kind is SECURITY else "loan"
    key = ("prefix", "security_id") if kind is SECURITY else ("loan_id", "prefix")
    checks = [F.when(absent, f"{own} schema omits a required allowlisted field"), F.when(F.col("bad_width"), "row width does not match approved schema"), F.when((text(key[0]) == "") | (text(key[1]) == ""), f"{own} business key is incomplete")]
    if kind is SECURITY:
        raw = raw.withColumn("period", S.parse_factor_date(text("security_factor_date")))
        checks += [F.when(F.col("period").isNull(), "Security Factor Date is not MMCCYY"), F.when(F.col("period") != F.col("report_period"), "Security Factor Date does not match publication period")]
    checks.append(F.when(~correction.isin(*kind.corrections), f"{kind.label} is invalid"))
    if kind is SECURITY:
        checks.append(F.when(~text("security_status").isin(*SECURITY_STATUSES), "Security Status Indicator is invalid"))
    numbers = []
    for target, column, scale, label in kind.numbers:
        parsed, what = (S.parse_integer(text(target), sound[target]), "integer") if scale is None else (S.parse_scaled(text(target), scale, sound[target]), "decimal")
        checks.append(F.when(~sound[target], f"{label} is not a valid {what}"))
        numbers.append(parsed.alias(column))
    row_class, checked, letters = F.col("row_class"), {}, []
    for rule in kind.rules if with_rules else ():
        # Corrections are judged once for all rules: a row with a wrong one has failed the check above, before any rule.
        classes, target = provider_rules.PROHIBITED[kind.name].get(rule["target"]), rule["target"]
        prohibited = row_class.isin(*classes) if classes else None
        letter = fields.blank_letter(rule, row_class, prohibited) if target not in known else None
        if letter is None:
            checked[target] = fields.validated(rule, text(target), row_class, None, prohibited).alias(f"rule_{target}")
            letter = fields.letter(F.col(f"rule_{target}.status"))
        letters.append(letter)
    identity = [text("security_id").alias("security_id"), text("prefix").alias("prefix"), text("security_status").alias("security_status")] if kind is SECURITY else [text("loan_id").alias("loan_id"), S.blank_to_null(text("security_id")).alias("security_id"), text("prefix").alias("prefix")]
    hashed = S.record_hash(*(cell(t) for t in known))
    out = raw.select(*LINEAGE, "report_period", *identity, correction.alias("correction_indicator"), *numbers, *(S.blank_to_null(text(t)).alias(t) for t in kind.texts), F.coalesce(*checks).alias("error"), hashed.alias("record_hash"), *checked.values(), "row_class", "bad_context")
    own = [c for c in out.columns if not c.startswith("rule_") and c not in ("row_class", "bad_context")]
    kinds = {"integer": "bigint", "decimal": "bigint"}
    null = lambda rule: F.lit(None).cast(kinds.get(rule["type"], "string"))
    if with_rules:
        own.remove("error")
        named = {t: F.col(f"rule_{t}") for t in checked}
        values = [F.when(~F.col("bad_context") & (named[r["target"]]["status"] == "valid"), fields.normalised(r, named[r["target"]]["value"])) if r["target"] in named else null(r) for r in kind.rules]
        wrong = F.concat(*(x if r.get("presence") == "absent" else F.lit(fields.STATUS_CODES["error"]) for r, x in zip(kind.rules, letters)))
        return out.select(*own, *(v.alias(stored_name(r)) for r, v in zip(kind.rules, values)), F.when(F.col("bad_context"), wrong).otherwise(F.concat(*letters)).alias("v2_field_statuses"), F.coalesce("error", *(n["error"] for n in named.values())).alias("error"))
    return out.select(*own, *(null(r).alias(stored_name(r)) for r in kind.rules), F.lit("-" * len(kind.rules)).alias("v2_field_statuses"))


def dispositions(facts: DataFrame, kind: Kind, keep=lambda frame: frame) -> DataFrame:
    """``typed`` facts with ``disposition``: rejected, accepted (the first of its key by family, file and row) or duplicate.

    Only sound rows compete for a key. All that is shuffled of them is a hash of their key; keys and places only of rows
    whose hash occurs again. The first place of each such key comes back, however many rows have it; where those keys are
    many, the places of the losers do."""
    valid = F.col("error").isNull()
    order = ("source_family", "source_file", "source_row")
    key_hash = F.xxhash64(*kind.key).alias("key_hash")
    sound = facts.where(valid).select(*kind.key, *order, key_hash)
    repeated = keep(sound.groupBy("key_hash").count().where("count > 1").select("key_hash"))
    if few(repeated):
        again = sound.join(F.broadcast(repeated), "key_hash", "left_semi")
        first = keep(again.groupBy("key_hash", *kind.key).agg(F.min(F.struct(*order)).alias("first")).select(F.col("key_hash").alias("of"), *(F.col(c).alias(f"of_{c}") for c in kind.key), "first"))
        same = F.col("key_hash") == F.col("of")
        for c in kind.key:
            same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
        hashed = facts.withColumn("key_hash", F.when(valid, key_hash))
        out = hashed.join(F.broadcast(first) if few(first) else first, same, "left").withColumn("again", F.col("first") != F.struct(*order))
        return out.withColumn("disposition", F.when(~valid, "rejected").when(F.col("again"), "duplicate").otherwise("accepted")).select(*facts.columns, "disposition")
    place = F.row_number().over(population.Window.partitionBy(*kind.key).orderBy(*order))
    again = sound.join(repeated, "key_hash", "left_semi").withColumn("place", place).where("place > 1")
    again = keep(again.select("source_file", "source_row", F.lit(True).alias("again")))
    out = facts.join(F.broadcast(again) if few(again) else again, ["source_file", "source_row"], "left")
    return out.withColumn("disposition", F.when(~valid, "rejected").when(F.col("again"), "duplicate").otherwise("accepted")).drop("again")


@dataclass
class Conformed:
    """Published facts, manifests of every source, rejected rows, and joins by month, family and reason."""

    securities: DataFrame
    loans: DataFrame
    manifest: DataFrame
    issues: DataFrame
    join_counts: DataFrame


def conform(lines: DataFrame, files: DataFrame, aliases: Mapping[str, Mapping[str, list[str]]], with_rules: bool = True, keep=lambda frame: frame, columns: Mapping[str, tuple[str, ...]] | None = None, loans_read_once: bool = False, heads: DataFrame | None = None) -> Conformed:
    """Conforms the usable files of an inventory. ``aliases``: by kind, target -> header names. ``keep`` stores what is
    read several times (writes and reads again, or persists).

    ``columns``: by kind, the facts' columns that the caller reads, beside those that judging and joining need; by default
    all. Every row is judged by every check either way. ``loans_read_once``: joined loans aren't stored.
    ``heads``: ``archives.headers`` of the lines, if they are stored."""
    heads = keep(archives.headers(lines)) if heads is None else heads
    facts_of = {k: typed(raw_rows(lines, files, k, aliases[k.name], keep, heads), k, aliases[k.name], with_rules) for k in (SECURITY, LOAN)}
    if columns is not None:
        facts_of = {k: f.select(*(c for c in f.columns if c in {*LINEAGE, *k.key, *JOINING, "error", *columns.get(k.name, ())})) for k, f in facts_of.items()}
    with release.compiled(lines.sparkSession):
        kept = {k: keep(f.drop(*OF_FILE)) for k, f in facts_of.items()}
    judged = {k: dispositions(f, k, keep) for k, f in kept.items()}
    counts = None
    for d in judged.values():
        own = d.select("source_file", "disposition")
        counts = own if counts is None else counts.unionByName(own)
    # Rows are counted by file alone; what else a manifest says is the same for all of a file.
    by = ["source_file", "source_family", "report_period", "schema_version", "publication_date", "as_of_timestamp"]
    published = S.publication_date(F.col("member"))
    known = heads.select("file", published.alias("publication_date"), S.as_of_timestamp(published).alias("as_of_timestamp"))
    known = files.select(F.col("file").alias("source_file"), F.col("family").alias("source_family"), "report_period", "schema_version").join(known.withColumnRenamed("file", "source_file"), "source_file")
    counted = population.manifest(counts, ["source_file"])
    manifest = counted.join(known, "source_file").select(*by, *(c for c in counted.columns if c != "source_file"))
    manifest = manifest.withColumn("reason", F.lit("SOURCE_CONFORMANCE"))
    other = files.where("blocker is null").where(~F.col("family").startswith(SECURITY.prefix) & ~F.col("family").startswith(LOAN.prefix))
    zero, n = F.lit(0).cast("bigint"), F.col("lines").cast("bigint")
    supplemental = other.select(
        F.col("file").alias("source_file"), F.col("family").alias("source_family"), "report_period", "schema_version", F.lit(None).cast("string").alias("publication_date"), F.lit(None).cast("string").alias("as_of_timestamp"), n.alias("input_count"), zero.alias("accepted_count"),
        n.alias("excluded_count"), zero.alias("rejected_count"), zero.alias("duplicate_count"), zero.alias("quarantined_count"), F.lit("pass").alias("quality_status"), zero.alias("published_count"), F.lit("SUPPLEMENTAL_NATIVE_GRAIN_M5_DEFERRED").alias("reason"),
    )
    manifest = keep(manifest.unionByName(supplemental))
    passing = manifest.where("quality_status = 'pass'").select("source_file", *OF_FILE)
    # All rows of a source that passes were accepted.
    facts = {k: f.join(passing, "source_file").select(*(c for c in facts_of[k].columns if c != "error")) for k, f in kept.items()}
    loans = population.join_reason(facts[LOAN], facts[SECURITY])
    loans = loans if loans_read_once else keep(loans)
    issues = None
    for k, d in judged.items():
        own = d.where("disposition != 'accepted'").select("source_file", "source_row", F.when(F.col("disposition") == "rejected", f"INVALID_{k.name.upper()}_ROW").otherwise("DUPLICATE_KEY").alias("code"), F.coalesce("error", F.lit("duplicate key")).alias("detail"))
        issues = own if issues is None else issues.unionByName(own)
    return Conformed(facts[SECURITY], loans, manifest, issues, population.join_counts(loans, ("report_period", "source_family")))


def load(spark: SparkSession, path: str, contract: Mapping[str, Any], aliases: Mapping[str, Mapping[str, list[str]]], work: str, **options: Any) -> Conformed:
    """Conforms every archive below ``path``; archives are read once, into Parquet below ``work``."""

    def keep(frame: DataFrame) -> DataFrame:
        return archives.stored(frame, work)

    lines = keep(archives.zip_lines(spark, path))
    return conform(lines, keep(archives.inventory(lines, contract)), aliases, keep=keep, **options)


#: Tables that ``write`` keeps by source file.
PUBLISHED = ("securities", "loans", "issues", "manifest")


def write(found: Conformed, root: str, after=lambda step: None) -> None:
    """Publishes a batch by source file, each table in one gated commit (``parts.Parts``): facts have as many rows as their
    manifest publishes, or nothing changes; a repeated or later run replaces its own files only. Manifests come last, so a
    file counts as published once they say so. Join counts are by month."""
    spark = found.manifest.sparkSession
    of = lambda kind: found.manifest.where(F.col("source_family").startswith(kind.prefix)).select(F.col("source_file").alias("part"), F.col("published_count").cast("long").alias("rows"))
    for name, frame, expected in (("securities", found.securities, of(SECURITY)), ("loans", found.loans, of(LOAN))):
        Parts(spark, f"{root}/{name}", after).commit(frame.withColumn("part", F.col("source_file")), expected)
    files = found.manifest.select(F.col("source_file").alias("part"))
    for name, frame, by, expected in (("issues", found.issues, "source_file", files), ("join_counts", found.join_counts, "report_period", None), ("manifest", found.manifest, "source_file", files)):
        kept = release.staged(frame.withColumn("part", F.col(by)), f"{root}/building")
        known = digests(kept)
        expected = known if expected is None else expected.join(known, "part", "left").select("part", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "digest")
        Parts(spark, f"{root}/{name}", after).commit(kept, expected)


def published(spark: SparkSession, root: str, name: str, files: list[str] | None = None) -> DataFrame:
    """A table that ``write`` published, or its rows of some source files."""
    found = Parts(spark, f"{root}/{name}").read(files)
    if found is None:
        raise FileNotFoundError(f"no {name} below {root}")
    return found.drop("part")
