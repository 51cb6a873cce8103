"""The engine's entry points: conform sources, build and verify metrics, make the payload."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as C
from ..operators import population
from . import cube, transitions, verify
from . import payload as product


def conform(securities: DataFrame, loans: DataFrame, key: tuple[str, ...] = ("report_period", "security_id")) -> dict[str, DataFrame]:
    """Versions, lineage and reason-coded joins of fact tables that carry as_of_timestamp, publication_date and source_id."""
    passing = securities.where("quality_status = 'pass'")
    joined = population.join_reason(loans.drop("join_reason"), passing)
    return {
        **{v: population.version_view(securities, list(key), v) for v in C.VIEWS},
        "lineage": population.lineage(securities, list(key)),
        "loans": joined,
        "join_counts": population.join_counts(joined),
    }


def build_metrics(securities: Mapping[str, DataFrame], loans: DataFrame, issuance: DataFrame, groups, manifests: DataFrame, join_counts: DataFrame, expected: DataFrame, issued: DataFrame | None = None, keep=lambda frame: frame) -> DataFrame:
    """All released contracts in one cube.

    Other metrics are derived from the loan base and the security cubes, aggregates with a few rows for each month and
    member. ``keep`` may store these (write and read again, or persist, which its caller then undoes); without it their
    exchanges are reused where Spark finds them equal."""
    loan = keep(cube.loan_base(loans))
    security = [keep(cube.security_cube(f, v)) for v, f in securities.items()]
    issuances = cube.issuance(issuance, groups)
    return cube.union(
        [
            loan, cube.top_n(loan), *security, issuances, cube.trust(manifests, issued=issued), cube.join_coverage(join_counts), cube.file_completeness(expected),
            cube.hhi(loan), cube.threshold_rates(loan), cube.modification_rate(loan), cube.issuance_share(cube.union([issuances, *security])),
            transitions.transition_cube(loans),
        ]
    )


def verify_metrics(built: DataFrame, loans: DataFrame, securities: Mapping[str, DataFrame], manifests: DataFrame | None = None, join_counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Violations by check; all empty for a sound cube. ``join_counts``: report_period, join_reason, row_count."""
    more = {}
    if manifests is not None:
        more |= {"schema_coverage": verify.schema_coverage(built, manifests), "manifests": population.unreconciled(manifests)}
    if join_counts is not None:
        more["join_totals"] = verify.join_totals(join_counts, loans)
    return more | {
        "contract_set": verify.contract_set(built),
        "repeated_keys": cube.repeated_keys(built),
        "view_coverage": verify.view_coverage(built, securities["latest"].select("report_period")),
        "segment_sums": verify.segment_sums(built),
        "summaries": verify.summaries(built),
        "hhi": verify.hhi_recomputed(built),
        "weighted": verify.weighted_recomputed(built),
        "thresholds": verify.thresholds_recomputed(built, loans),
        "modification": verify.modification_recomputed(built, loans),
        **{f"removal_{v}": verify.removal_recomputed(built, f, v) for v, f in securities.items()},
        "transition_coverage": verify.transition_coverage(built, loans),
        "transition_sums": verify.transition_sums(built),
        "new_delinquency": verify.new_delinquency_matches(built),
        "cohort_sums": verify.cohort_sums(built),
        "unreleased": verify.unreleased(built),
    }


def dashboard(built: DataFrame) -> dict[str, Any]:
    """Series of the latest view and concentrations with HHI, as plain values; one row per month and dimension.

    Loan metrics exist in the latest view only, so that no month of the original one is complete."""
    out: dict[str, Any] = {v: product.complete([r.asDict() for r in product.series(built, v).orderBy("report_period").collect()]) for v in ("latest",)}
    out["concentration"] = [r.asDict() for r in product.with_hhi(product.concentration(built), built).collect()]
    out["components"] = built.agg(F.count("*")).first()[0]
    return out
