"""Field rules of the two monthly families, and row classes by prefix.

Rules are data for ``operators.fields``; a contract document may carry its own instead."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes of special products; any other prefix is ``standard``.
PREFIX_CLASSES = {
    "reinstated": ("3Y", "3Z", "4I", "4J", "4K", "6T", "B9", "R0"),
    "modified-step-rate": ("4A", "4B", "4C", "4D", "HA", "HB", "HC", "HD"),
    "modified-fixed-rate": ("4E", "4F", "4G", "4H", "MA", "MB", "MC", "MD"),
    "arm": ("1A", "1B", "1C", "1E", "1G", "1H", "1J", "1K", "1L", "1M", "1N", "1Q", "1R", "2B", "35", "39", "40", "41", "42", "5A", "60", "61", "63", "64", "71", "74", "75", "76", "77", "78", "84", "86", "87", "8A", "8B", "8C", "8D", "94", "96", "97"),
}
_MODIFIED = ("reperforming", "modified-fixed-rate", "modified-step-rate")
#: Fields that must be blank (or a sentinel) in rows of some classes.
PROHIBITED = {
    "security": {"wa_current_interest_rate": ("arm",), "wa_ltv": _MODIFIED, "wa_cltv": _MODIFIED},
    "loan": {"current_interest_rate": ("arm",), "ltv": _MODIFIED, "cltv": _MODIFIED, "occupancy_status": _MODIFIED, "channel": _MODIFIED},
}


def _rate(target: str) -> dict[str, Any]:
    return {"target": target, "type": "decimal", "scale": 3, "sentinels": [("99.999", "not_available")]}


def _ratio(target: str, **more: Any) -> dict[str, Any]:
    return {"target": target, "type": "integer", "sentinels": [("999", "not_available")], "range": {"min": 0, "max": 998}} | more


def _amount(target: str, **more: Any) -> dict[str, Any]:
    return {"target": target, "type": "decimal", "scale": 2, "range": {"min": 0, "max": 10**12}} | more


def _code(target: str, *values: str, **more: Any) -> dict[str, Any]:
    return {"target": target, "type": "enum", "valid_values": list(values), "sentinels": [("9", "not_available")]} | more


def _date(target: str, form: str = "MMCCYY", **more: Any) -> dict[str, Any]:
    return {"target": target, "type": "date", "raw_format": form} | more


_CHANGED = {"row_classes": [*_MODIFIED, "reinstated"]}
SECURITY_RULES = (
    _date("issue_date", "MMDDCCYY", fixed_day="01"), _date("maturity_date"), _rate("wa_net_interest_rate"), _rate("wa_issuance_interest_rate"), _rate("wa_current_interest_rate"),
    _ratio("wa_ltv"), _ratio("wa_cltv"), _ratio("wa_dti"), _ratio("wa_eltv", **_CHANGED),
    {"target": "mission_density_score", "type": "decimal", "scale": 2, "range": {"min": 0, "max": 3, "out_of_range_action": "not_available"}},
    {"target": "mission_criteria_share", "type": "decimal", "scale": 2, "range": {"min": 0, "max": 100, "out_of_range_action": "not_available"}},
    _code("green_indicator", "Y", "N"), _code("social_indicator", "Y", "N"), _code("mission_index_version", "V1.0", "V1.1"),
)
LOAN_RULES = (
    _rate("original_interest_rate"), _rate("issuance_interest_rate"), _rate("current_interest_rate"), _rate("issuance_net_interest_rate"), _rate("current_net_interest_rate"),
    _date("first_payment_date"), _date("maturity_date"), _ratio("ltv"), _ratio("cltv"), _ratio("dti"), _code("first_time_homebuyer", "Y", "N"), _code("loan_purpose", "P", "C", "N", "R"),
    _code("occupancy_status", "P", "I", "S"), {"target": "number_of_units", "type": "integer", "sentinels": [("99", "not_available")], "range": {"min": 1, "max": 4}}, _code("property_type", "SF", "CO", "PU", "MH", "CP"),
    _code("channel", "R", "B", "C", "T"), {"target": "mortgage_insurance_percent", "type": "integer", "sentinels": [("999", "not_available")], "range": {"min": 0, "max": 100}},
    _code("mortgage_insurance_cancellation", "Y", "N"), _code("government_insured_guarantee", "FH", "VA", "RH", "IH"), _code("modification_type", "F", "A", "S", **_CHANGED),
    {"target": "number_of_modifications", "type": "integer", "range": {"min": 0, "max": 99}, **_CHANGED}, _amount("total_capitalized_amount", **_CHANGED), _amount("original_deferred_amount", **_CHANGED), _ratio("eltv", **_CHANGED),
    _date("origination_first_payment_date", **_CHANGED), _code("alternative_resolution", "P", "D", "C"), {"target": "alternative_resolution_count", "type": "integer", "range": {"min": 0, "max": 99}},
    _amount("total_deferral_amount"), _code("borrower_assistance_plan", "F", "R", "T", "O"), _code("special_eligibility_program", "H", "R", "F"),
)
ACQUISITION_RULES = ({"target": "acquired_at", "type": "timestamp", "nullable": False},)


def row_class(prefix: Column) -> Column:
    out = F.lit("standard")
    for name, prefixes in PREFIX_CLASSES.items():
        out = F.when(prefix.isin(*prefixes), name).otherwise(out)
    return out
