"""Column sets of the engine's tables. Money is long cents; sums of products are decimal(38,0)."""

from __future__ import annotations

WIDE = "decimal(38,0)"

#: The tall cube that every metric ends in; the first seven columns are its key.
KEY = ("contract_id", "component", "report_period", "correction_view", "grain", "dimension", "member")
COMPONENT = (*KEY, "numerator", "denominator", "observations", "value", "released")

#: Fixed values.
DISPOSITIONS = ("input", "accepted", "excluded", "rejected", "duplicate", "quarantined", "published")

#: The ids of the contracts that the catalog releases.
CONTRACTS = (
    "source_population_accounting", "source_disposition_rates", "schema_transition_status", "join_coverage", "file_completeness", "issuance_volume", "security_size_distribution",
    "issuance_product_mix", "period_change", "rolling_issuance", "current_outstanding_balance_population", "loan_balance_distribution", "correction_restatement_volume", "deferred_upb_share",
    "weighted_age_maturity", "weighted_rates", "ltv_metrics", "dti_metric", "credit_score_model_metrics", "delinquency_distribution", "state_composition", "counterparty_composition",
    "modification_volume", "guarantee_mi_share", "first_time_homebuyer_share", "loan_property_composition", "assistance_resolution_share", "green_social_eligibility", "mission_metrics",
    "factor_level_change", "involuntary_removal_volume", "involuntary_removal_share", "new_issuance_share_ending_book", "hhi_concentration", "delinquency_threshold_rates", "modification_rate",
    "delinquency_roll_cure", "new_delinquency_redefault",
)

#: Fixed values, as are the names above.
MISSING = "Missing"
VIEWS = ("original", "latest")

#: Attributes averaged with balances as weights, and the contract that each belongs to.
LOAN_SCORES = ("legacy_credit_score", "classic_fico", "vs4", "updated_legacy_credit_score", "updated_classic_fico", "updated_vs4")
LOAN_RATES = ("original_interest_rate_milli_pct", "issuance_interest_rate_milli_pct", "current_interest_rate_milli_pct", "issuance_net_interest_rate_milli_pct", "current_net_interest_rate_milli_pct")
LOAN_RATIOS = {"ltv_pct": "ltv_metrics", "cltv_pct": "ltv_metrics", "eltv_pct": "ltv_metrics", "dti_pct": "dti_metric"}
SECURITY_RATES = ("wa_net_interest_rate_milli_pct", "wa_issuance_interest_rate_milli_pct", "wa_current_interest_rate_milli_pct")
SECURITY_RATIOS = {"wa_ltv_pct": "ltv_metrics", "wa_cltv_pct": "ltv_metrics", "wa_eltv_pct": "ltv_metrics", "wa_dti_pct": "dti_metric"}
SECURITY_SCORES = ("legacy_credit_score", "classic_fico", "vs4")

#: Dimension -> (contract, column) of loan compositions.
LOAN_SEGMENTS = {
    "ltv": ("ltv_metrics", "ltv_pct"),
    "cltv": ("ltv_metrics", "cltv_pct"),
    "eltv": ("ltv_metrics", "eltv_pct"),
    "first_time_homebuyer": ("first_time_homebuyer_share", "first_time_homebuyer"),
    "loan_purpose": ("loan_property_composition", "loan_purpose"),
    "occupancy_status": ("loan_property_composition", "occupancy_status"),
    "number_of_units": ("loan_property_composition", "number_of_units"),
    "property_type": ("loan_property_composition", "property_type"),
    "channel": ("loan_property_composition", "channel"),
    "government_guarantee": ("guarantee_mi_share", "government_insured_guarantee"),
    "alternative_resolution": ("assistance_resolution_share", "alternative_resolution"),
    "borrower_assistance_plan": ("assistance_resolution_share", "borrower_assistance_plan"),
    "special_eligibility_program": ("green_social_eligibility", "special_eligibility_program"),
    "prefix": ("current_outstanding_balance_population", "prefix"),
    "state": ("state_composition", "property_state"),
    "seller": ("counterparty_composition", "seller_name"),
    "servicer": ("counterparty_composition", "servicer_name"),
}
