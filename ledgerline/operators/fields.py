"""Field rules: a contract's field compiled into one expression of (status, value, error).

A rule is a mapping with target, type (text, integer, decimal, enum, date, timestamp), nullable, null_tokens,
max_length, valid_values, scale, raw_format, fixed_day, sentinels ((raw, meaning) pairs), range (min, max,
out_of_range_action), row_classes, indicators and presence. The order of checks decides which error shows."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPES = ("text", "integer", "decimal", "enum", "date", "timestamp")
DATE_FORMATS = {"MMCCYY": "MMyyyy", "MMDDCCYY": "MMddyyyy"}
#: One letter for each status, for the packed form.
STATUS_CODES = {"valid": "V", "null": "0", "not_available": "N", "not_applicable": "A", "error": "?"}


class RuleError(ValueError):
    """A field contract that cannot be compiled."""


def validate_rule(rule: Mapping[str, Any]) -> None:
    if rule.get("type") not in TYPES:
        raise RuleError(f"{rule.get('target')}: unknown type")
    if rule["type"] == "enum" and not rule.get("valid_values"):
        raise RuleError(f"{rule['target']}: an enum needs its values")
    if rule["type"] == "decimal" and not isinstance(rule.get("scale"), int):
        raise RuleError(f"{rule['target']}: a decimal needs its scale")
    if rule["type"] == "date" and rule.get("raw_format") not in DATE_FORMATS:
        raise RuleError(f"{rule['target']}: unknown date format")
    limits = rule.get("range")
    if limits and not (limits["min"] <= limits["max"] and limits.get("out_of_range_action", "error") in ("error", "not_available")):
        raise RuleError(f"{rule['target']}: bad range")


def _parse_error(rule: Mapping[str, Any], value: Column) -> Column:
    """Message if ``value`` is not of the rule's type, else null."""
    name, kind = rule["target"], rule["type"]
    if kind == "enum":
        return F.when(~value.isin(*rule["valid_values"]), f"{name} has an unknown code")
    if kind == "integer":
        return F.when(~value.rlike(r"^-?\d+$"), f"{name} is not an integer")
    if kind == "decimal":
        fraction = F.length(F.regexp_extract(value, r"\.(\d+)$", 1))
        return F.when(~value.rlike(r"^-?\d+(\.\d+)?$"), f"{name} is not a decimal").when(fraction > rule["scale"], f"{name} exceeds approved scale")
    if kind == "date":
        digits = len(DATE_FORMATS[rule["raw_format"]])
        bad = ~value.rlike(rf"^\d{{{digits}}}$") | F.try_to_timestamp(value, F.lit(DATE_FORMATS[rule["raw_format"]])).isNull()
        out = F.when(bad, f"{name} has an invalid date")
        return out.when(F.substring(value, 3, 2) != rule["fixed_day"], f"{name} has an invalid provider-defaulted day") if rule.get("fixed_day") else out
    if kind == "timestamp":
        shape = value.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
        return F.when(~shape | F.try_to_timestamp(F.substring(value, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNull(), f"{name} is not UTC RFC3339 seconds")
    return F.when(value == "", f"{name} is empty")


def validated(rule: Mapping[str, Any], raw: Column, row_class: Column | None = None, indicator: Column | None = None, prohibited: Column | None = None) -> Column:
    """Struct of status, value (text) and error for one field."""
    validate_rule(rule)
    name = rule["target"]
    value = F.trim(F.coalesce(raw, F.lit("")))
    empty = value.isin(*rule.get("null_tokens", [""]))
    out = lambda status, v=None, error=None: F.struct(F.lit(status).alias("status"), (F.lit(None) if v is None else v).cast("string").alias("value"), F.lit(error).cast("string").alias("error"))
    bad = lambda message: out("error", None, message)
    if rule.get("presence") == "absent":
        return F.when(value != "", bad(f"{name} must be absent")).otherwise(out("not_applicable"))
    steps: list[tuple[Column, Column]] = []
    if indicator is not None:
        steps.append((~F.coalesce(indicator.isin(*rule.get("indicators", ["N"])), F.lit(False)), bad(f"{name} has invalid correction context")))
    if rule.get("row_classes") and row_class is not None:
        outside = ~F.coalesce(row_class.isin(*rule["row_classes"]), F.lit(False))
        steps += [(outside & (value != ""), bad(f"{name} is populated outside its applicable row class")), (outside, out("not_applicable"))]
    sentinels = [(value == raw_value, out(meaning)) for raw_value, meaning in rule.get("sentinels", ())]
    if prohibited is not None:
        steps.append((prohibited & empty, out("not_applicable")))
        steps += [(prohibited & hit, result) for hit, result in sentinels]
        steps.append((prohibited, bad(f"{name} is populated for a prohibited row class")))
    steps.append((empty, out("null") if rule.get("nullable", True) else bad(f"{name} is required")))
    steps += sentinels
    if rule.get("max_length"):
        steps.append((F.length(value) > rule["max_length"], bad(f"{name} exceeds max length")))
    error = _parse_error(rule, value)
    steps.append((error.isNotNull(), F.struct(F.lit("error").alias("status"), F.lit(None).cast("string").alias("value"), error.alias("error"))))
    if rule.get("range"):
        limits = rule["range"]
        outside = ~F.coalesce(value.try_cast("decimal(38,10)").between(F.lit(limits["min"]).cast("decimal(38,10)"), F.lit(limits["max"]).cast("decimal(38,10)")), F.lit(False))
        steps.append((outside, out("not_available") if limits.get("out_of_range_action") == "not_available" else bad(f"{name} is outside its approved range")))
    chain = F.when(*steps[0])
    for condition, result in steps[1:]:
        chain = chain.when(condition, result)
    return chain.otherwise(F.struct(F.lit("valid").alias("status"), value.alias("value"), F.lit(None).cast("string").alias("error")))


def letter(status: Column) -> Column:
    codes = F.create_map(*(F.lit(x) for k, v in STATUS_CODES.items() for x in (k, v)))
    return F.coalesce(F.element_at(codes, status), F.lit("?"))


def packed(fields: list[Column]) -> Column:
    """One letter for each field's status; a dash without fields."""
    return F.concat(*(letter(f["status"]) for f in fields)) if fields else F.lit("-")


def blank_letter(rule: Mapping[str, Any], row_class: Column | None = None, prohibited: Column | None = None) -> Column | None:
    """The letter of ``validated`` for a blank cell, where a blank cell cannot be an error (None if it can)."""
    validate_rule(rule)
    if rule.get("presence") == "absent":
        return F.lit(STATUS_CODES["not_applicable"])
    if "" not in rule.get("null_tokens", [""]) or not rule.get("nullable", True):
        return None
    out = F.lit(STATUS_CODES["null"])
    if prohibited is not None:
        out = F.when(prohibited, STATUS_CODES["not_applicable"]).otherwise(out)
    if rule.get("row_classes") and row_class is not None:
        out = F.when(F.coalesce(row_class.isin(*rule["row_classes"]), F.lit(False)), out).otherwise(STATUS_CODES["not_applicable"])
    return out


def normalised(rule: Mapping[str, Any], value: Column) -> Column:
    """A valid value in stored form: scaled integers, months and days as ISO text."""
    if rule["type"] == "integer":
        return value.try_cast("bigint")
    if rule["type"] == "decimal":
        return (value.try_cast("decimal(38,10)") * (10 ** rule["scale"])).cast("bigint")
    if rule["type"] == "date" and rule["raw_format"] == "MMCCYY":
        return F.concat(F.substring(value, 3, 4), F.lit("-"), F.substring(value, 1, 2))
    if rule["type"] == "date":
        return F.concat(F.substring(value, 5, 4), F.lit("-"), F.substring(value, 1, 2), F.lit("-"), F.substring(value, 3, 2))
    return value
