"""Metric families: facts in, rows of the tall cube out.

Each family is one aggregation over its facts (one more for its segments); the wide result is turned into
rows by a single explode, so no metric scans the facts again. ``only`` keeps contracts, before any row is made."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as C
from ..functions import scalars as S
from ..operators import order
from .parts import workspace

TOP_N = 10


def _all(*conditions: Column) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def row(contract: str, component: str, numerator, denominator=None, observations=None, dimension="portfolio", member="All", value=None, when=None, scale: int = 1) -> dict:
    """A cube row to be made from a wide one; all but contract, component and dimension are columns or names."""
    return {"contract": contract, "component": component, "numerator": numerator, "denominator": denominator, "observations": observations, "dimension": dimension, "member": member, "value": value, "when": when, "scale": scale}


def _column(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tall(wide: DataFrame, rows: Iterable[dict], view: str | Column, grain: str, only: Iterable[str] | None = None) -> DataFrame | None:
    """Rows of the cube from a wide frame with ``report_period``; None if ``only`` leaves no row."""
    made = []
    for r in rows:
        if only is not None and r["contract"] not in only:
            continue
        numerator = S.wide(_column(r["numerator"]))
        denominator = F.lit(None).cast(C.WIDE) if r["denominator"] is None else S.wide(_column(r["denominator"]))
        value = S.safe_ratio(numerator, denominator, r["scale"]) if r["value"] is None else r["value"]
        label = F.lit(r["member"]) if isinstance(r["member"], str) else r["member"]
        struct = F.struct(
            F.lit(r["contract"]).alias("contract_id"), F.lit(r["component"]).alias("component"), F.lit(r["dimension"]).alias("dimension"), label.alias("member"),
            numerator.alias("numerator"), denominator.alias("denominator"), _column(r["observations"]).cast("bigint").alias("observations"), value.cast("double").alias("value"),
        )
        made.append(struct if r["when"] is None else F.when(r["when"], struct))
    if not made:
        return None
    out = wide.select("report_period", (F.lit(view) if isinstance(view, str) else view).alias("correction_view"), F.explode(F.array(*made)).alias("r")).where("r is not null")
    return out.select("r.contract_id", "r.component", "report_period", "correction_view", F.lit(grain).alias("grain"), "r.dimension", "r.member", "r.numerator", "r.denominator", "r.observations", "r.value", F.col("r.contract_id").isin(*C.CONTRACTS).alias("released"))


def union(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out if f is None else out.unionByName(f)
    return out


def repeated_keys(cube: DataFrame) -> DataFrame:
    """Keys that occur more than once; none, if all is well."""
    return cube.groupBy(*C.KEY).agg(F.count("*").alias("n")).where("n > 1")


# ---- sources


def trust(manifests: DataFrame, only=None, issued: DataFrame | None = None) -> DataFrame | None:
    """Populations and disposition rates by source file family; manifests have one row per family and period.

    ``issued``: manifests of the issuance pipeline by report_period, which have their population accounted, too."""
    dims = {"dimension": "source_family", "member": F.col("source_family"), "observations": "input_count"}
    rows = [row("source_population_accounting", f"{d}_count", f"{d}_count", **dims) for d in C.DISPOSITIONS]
    rows += [row("source_disposition_rates", f"{d}_rate", f"{d}_count", "input_count", **dims) for d in C.DISPOSITIONS]
    rows.append(row("schema_transition_status", "schema_pass", (F.col("quality_status") == "pass").cast("int"), F.lit(1), F.lit(1), "source_family", F.col("source_family")))
    own = [row("source_population_accounting", f"{d}_count", f"{d}_count", observations="input_count", dimension="source_family", member="issuance") for d in C.DISPOSITIONS]
    frames = [tall(manifests, rows, "latest", "source", only), tall(issued, own, "latest", "source", only) if issued is not None else None]
    return union([*frames, schema_changes(manifests) if only is None or "schema_transition_status" in only else None])


def schema_changes(manifests: DataFrame) -> DataFrame:
    """1 where a family's set of schema versions differs from that of the month just before."""
    sets = manifests.groupBy("source_family", "report_period").agg(F.array_sort(F.collect_set("schema_version")).alias("versions"))
    order = Window.partitionBy("source_family").orderBy("report_period")
    changed = S.adjacent(F.lag("report_period").over(order), F.col("report_period")) & (F.lag("versions").over(order) != F.col("versions"))
    sets = sets.withColumn("changed", F.coalesce(changed, F.lit(False)).cast("int"))
    return tall(sets, [row("schema_transition_status", "schema_transition_flag", "changed", F.lit(1), F.size("versions"), "source_family", F.col("source_family"))], "latest", "source")


def join_coverage(counts: DataFrame) -> DataFrame:
    """Share of each join reason over all periods. ``counts``: join_reason, row_count."""
    by = counts.groupBy("join_reason").agg(F.sum("row_count").alias("n"))
    total = by.withColumn("total", F.sum("n").over(Window.partitionBy())).withColumn("report_period", F.lit("all"))
    out = tall(total, [row("join_coverage", "reason", "n", "total", "n", "join_reason", F.col("join_reason"))], "latest", "loan-period")
    return out.withColumn("component", F.col("member"))


def file_completeness(expected: DataFrame) -> DataFrame:
    """``expected``: family, report_period, received."""
    return tall(expected, [row("file_completeness", "required_package", "received", F.lit(1), "received", "source_family", F.col("family"))], "latest", "source")


# ---- issuance


def issuance(facts: DataFrame, groups: Column, only=None) -> DataFrame | None:
    """``facts``: report_period, issuance_cents; ``groups``: the product group of a row."""
    monthly = facts.groupBy("report_period").agg(F.count("*").alias("n"), F.sum("issuance_cents").alias("upb"))
    wanted = lambda *names: only is None or set(names) & set(only)
    sizes = monthly
    if wanted("security_size_distribution"):
        middle = order.order_statistics(facts, ["report_period"], "issuance_cents", {"middle": order.between(0.5)}, f"{workspace(facts.sparkSession)}/medians")
        sizes = monthly.join(middle, "report_period", "left")
    frames = [
        tall(
            sizes if "middle" in sizes.columns else sizes.withColumn("middle", F.lit(None).cast("double")),
            [
                row("issuance_volume", "issuance_upb", "upb", None, "n"),
                row("issuance_volume", "issued_security_count", "n", None, "n"),
                row("security_size_distribution", "average_issuance_security_size", "upb", "n", "n"),
                row("security_size_distribution", "median_issuance_security_size", F.bround("middle"), None, "n"),
            ],
            "latest", "issuance", only,
        )
    ]
    if wanted("issuance_product_mix"):
        by = facts.groupBy("report_period", groups.alias("product_group")).agg(F.count("*").alias("n"), F.sum("issuance_cents").alias("upb"))
        month = Window.partitionBy("report_period")
        by = by.withColumn("all_n", F.sum("n").over(month)).withColumn("all_upb", F.sum("upb").over(month))
        dims = {"dimension": "product_group", "member": F.col("product_group"), "observations": "n"}
        frames.append(tall(by, [row("issuance_product_mix", "group_count", "n", "all_n", **dims), row("issuance_product_mix", "group_upb", "upb", "all_upb", **dims)], "latest", "issuance"))
    if wanted("period_change"):
        frames.append(period_change(monthly))
    if wanted("rolling_issuance"):
        frames.append(rolling(monthly))
    return union(frames)


def period_change(monthly: DataFrame) -> DataFrame:
    """Change against 1, 3 and 12 months before, where the months between are all there."""
    order = Window.orderBy("report_period")  # monthly rows: a few hundred
    rows, wide = [], monthly
    for offset, label in ((1, "mom"), (3, "qoq"), (12, "yoy")):
        wide = wide.withColumn(f"near_{label}", S.adjacent(F.lag("report_period", offset).over(order), F.col("report_period"), offset))
        for measure, name in (("upb", "upb"), ("n", "count")):
            wide = wide.withColumn(f"{measure}_{label}", F.lag(measure, offset).over(order))
            rows.append(row("period_change", f"issuance_{name}_{label}", F.col(measure) - F.col(f"{measure}_{label}"), f"{measure}_{label}", "n", when=F.col(f"near_{label}")))
    return tall(wide, rows, "latest", "issuance")


def rolling(monthly: DataFrame, windows: tuple[int, ...] = (3, 6, 12)) -> DataFrame:
    """Sums over 3, 6 and 12 months, only where no month is missing."""
    wide, rows = monthly.withColumn("month", S.month_index(F.col("report_period"))), []
    for w in windows:
        span = Window.orderBy("month").rangeBetween(-(w - 1), 0)
        wide = wide.withColumns({f"full_{w}": F.count("*").over(span) == w, f"upb_{w}": F.sum("upb").over(span), f"n_{w}": F.sum("n").over(span)})
        rows += [row("rolling_issuance", f"rolling_{w}_upb", f"upb_{w}", None, f"n_{w}", when=F.col(f"full_{w}")), row("rolling_issuance", f"rolling_{w}_count", f"n_{w}", None, f"n_{w}", when=F.col(f"full_{w}"))]
    return tall(wide, rows, "latest", "issuance")


# ---- loans


def is_active_loan() -> Column:
    return _all(F.col("join_reason") == "matched", F.col("correction_indicator") != "D", F.coalesce(F.col("current_upb_cents") > 0, F.lit(False)))


def _weighted(value: str, weight: str, active: Column, name: str) -> list[Column]:
    use = active & (F.col(value) >= 0)
    return [
        F.sum(F.when(use, S.wide(F.col(value)) * F.col(weight)).cast(C.WIDE)).alias(f"{name}_num"),
        F.sum(F.when(use, S.wide(F.col(weight)))).alias(f"{name}_den"),
        F.count(F.when(use, 1)).alias(f"{name}_obs"),
    ]


#: name -> (contract, column, scale of the value)
LOAN_WEIGHTED = {
    "wala": ("weighted_age_maturity", "loan_age", 1),
    "wam": ("weighted_age_maturity", "remaining_months_to_maturity", 1),
    **{s: ("credit_score_model_metrics", s, 1) for s in C.LOAN_SCORES},
    **{r: ("weighted_rates", r, 1000) for r in C.LOAN_RATES},
    **{r: (contract, r, 1) for r, contract in C.LOAN_RATIOS.items()},
}


def loan_partials(loans: DataFrame, by: tuple[str, ...] = ("source_file", "report_period")) -> DataFrame:
    """All wide sums of one pass over the loans, for each partition: what an incremental build keeps."""
    active, upb = is_active_loan(), F.col("current_upb_cents")
    changed = F.col("correction_indicator") != "N"
    deferred = active & (F.col("current_deferred_upb_cents") >= 0)
    count = lambda c: F.count(F.when(c, 1))
    total = lambda c, x: F.sum(F.when(c, S.wide(x)))
    aggregates = [
        F.count("*").alias("rows"), count(active).alias("active_rows"), total(active, upb).alias("active_upb"), count(changed).alias("corrections"),
        total(changed, F.greatest(F.coalesce(upb, F.lit(0)), F.lit(0))).alias("correction_upb"), total(deferred, F.col("current_deferred_upb_cents")).alias("deferred_upb"),
        total(deferred, upb).alias("deferred_den"), count(deferred).alias("deferred_obs"),
    ]
    for name, (_, column, _) in LOAN_WEIGHTED.items():
        aggregates += _weighted(column, "current_upb_cents", active, name)
    return loans.groupBy(*by).agg(*aggregates)


def consolidated(partials: DataFrame) -> DataFrame:
    """Partials of all files summed by period; a sum stays null only where every part is null."""
    return partials.groupBy("report_period").agg(*(F.sum(c).alias(c) for c in partials.columns if c not in ("source_file", "report_period")))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast(C.WIDE))


def loan_totals(wide: DataFrame, only=None) -> DataFrame | None:
    rows = [
        row("current_outstanding_balance_population", "loan_upb", _zero("active_upb"), None, "active_rows"),
        row("current_outstanding_balance_population", "loan_count", "active_rows", None, "active_rows"),
        row("loan_balance_distribution", "average_current_loan_balance", _zero("active_upb"), "active_rows", "active_rows"),
        row("correction_restatement_volume", "loan_correction_count", "corrections", None, "rows"),
        row("correction_restatement_volume", "loan_correction_upb", _zero("correction_upb"), None, "corrections"),
        row("deferred_upb_share", "deferred_upb", _zero("deferred_upb"), None, "deferred_obs"),
        row("deferred_upb_share", "deferred_share", _zero("deferred_upb"), _zero("deferred_den"), "deferred_obs"),
    ]
    for name, (contract, _, scale) in LOAN_WEIGHTED.items():
        rows.append(row(contract, name, f"{name}_num", f"{name}_den", f"{name}_obs", when=F.col(f"{name}_obs") > 0, scale=scale))
    return tall(wide, rows, "latest", "loan-period", only)


#: dimension -> (contract, member), for all but scores.
def loan_dimensions() -> dict[str, tuple[str, Column]]:
    out = {d: (contract, S.member(F.col(column))) for d, (contract, column) in C.LOAN_SEGMENTS.items()}
    out["mortgage_insurance_status"] = ("guarantee_mi_share", S.insurance_status(F.col("mortgage_insurance_pct"), F.col("mortgage_insurance_cancellation")))
    out["delinquency_band"] = ("delinquency_distribution", S.delinquency_band(F.col("days_delinquent")))
    out["modification"] = ("modification_volume", S.modification_status(F.col("modification_program")))
    return out


def _member(dimension: str, contract: str, member: Column, one: Column | int = 1) -> Column:
    one = F.lit(one) if isinstance(one, int) else one
    return F.struct(F.lit(dimension).alias("dimension"), F.lit(contract).alias("contract"), member.alias("member"), one.alias("one"))


def score_members() -> list[Column]:
    """For each score its own member if it has one, and ``Missing``, which a null or negative score counts in (and months
    without such scores have with zero)."""
    out = []
    for s in C.LOAN_SCORES:
        d, contract = f"score:{s}", "credit_score_model_metrics"
        out += [F.when(F.col(s).isNotNull(), _member(d, contract, F.col(s).cast("string"))), _member(d, contract, F.lit(C.MISSING), (F.coalesce(F.col(s), F.lit(-1)) < 0).cast("int"))]
    return out


def segments(rows: DataFrame, dimensions: dict[str, tuple[str, Column]], weight: str, only=None, by: tuple[str, ...] = ("report_period",), more: list[Column] | None = None) -> DataFrame | None:
    """(dimension, member) counts and balances: rows are multiplied by the dimensions, then summed in each task first."""
    members = [_member(d, contract, m) for d, (contract, m) in dimensions.items() if only is None or contract in only] + (more or [])
    if not members:
        return None
    each = rows.select(*by, F.col(weight).alias("w"), F.explode(F.array(*members)).alias("s")).where("s is not null")
    upb = F.coalesce(F.sum(F.when(F.col("s.one") == 1, S.wide(F.col("w")))), F.lit(0).cast(C.WIDE))
    return each.groupBy(*by, "s.dimension", "s.contract", "s.member").agg(F.sum("s.one").alias("n"), upb.alias("upb"))


def _segment_rows(seg: DataFrame, view: str, grain: str) -> DataFrame:
    """Two cube rows for each segment; denominators are the totals of the dimension."""
    total = Window.partitionBy("report_period", "dimension")
    seg = seg.withColumn("all_n", F.sum("n").over(total)).withColumn("all_upb", F.sum("upb").over(total))
    both = F.array(*(F.struct(F.lit(b).alias("basis"), S.wide(F.col(v)).alias("numerator"), S.wide(F.col(t)).alias("denominator")) for b, v, t in (("count", "n", "all_n"), ("upb", "upb", "all_upb"))))
    out = seg.select("*", F.explode(both).alias("b"))
    return out.select(
        F.col("contract").alias("contract_id"), F.concat("dimension", F.lit("_"), "b.basis").alias("component"), "report_period", F.lit(view).alias("correction_view"), F.lit(grain).alias("grain"), "dimension", "member",
        "b.numerator", "b.denominator", F.col("n").alias("observations"), S.safe_ratio(F.col("b.numerator"), F.col("b.denominator")).alias("value"), F.col("contract").isin(*C.CONTRACTS).alias("released"),
    )


def loan_segments(loans: DataFrame, only=None) -> DataFrame | None:
    active = loans.where(is_active_loan())
    scores = score_members() if only is None or "credit_score_model_metrics" in only else None
    seg = segments(active, loan_dimensions(), "current_upb_cents", only, more=scores)
    if seg is None:
        return None
    return _segment_rows(seg, "latest", "loan-period")


def loan_base(loans: DataFrame, only=None) -> DataFrame | None:
    """Totals and segments: two aggregations over the loans. What is derived from them needs no loan again."""
    of_totals = {c for c, _, _ in LOAN_WEIGHTED.values()} | {"current_outstanding_balance_population", "loan_balance_distribution", "correction_restatement_volume", "deferred_upb_share"}
    totals = loan_totals(loan_partials(loans, ("report_period",)), only) if only is None or set(only) & of_totals else None
    return union([totals, loan_segments(loans, only)])


def loan_cube(loans: DataFrame, only=None) -> DataFrame | None:
    """Base and summaries of compositions. Asked for compositions alone, both come from one exchange."""
    wanted = tuple(c for c in dict.fromkeys(COMPOSITIONS.values()) if only is None or c in only)
    tops = top_n(loan_segments(loans, wanted), whole=True) if wanted else None
    return union([loan_base(loans, only), tops])


COMPOSITIONS = {"state": "state_composition", "seller": "counterparty_composition", "servicer": "counterparty_composition"}


def _compositions(cube: DataFrame) -> DataFrame:
    return cube.where(F.col("contract_id").isin(*set(COMPOSITIONS.values())) & F.col("dimension").isin(*COMPOSITIONS))


def top_n(cube: DataFrame, n: int = TOP_N, whole: bool = False) -> DataFrame:
    """The ``n`` largest members against the others, for states, sellers and servicers; ``whole``: ``cube`` has nothing else."""
    place = F.row_number().over(Window.partitionBy("report_period", "dimension", "component").orderBy(F.col("numerator").desc(), "member"))
    ranked = (cube if whole else _compositions(cube)).withColumn("top", place <= n)
    top = F.col("top")
    both = ranked.groupBy("contract_id", "report_period", "correction_view", "grain", "dimension", "component").agg(
        F.max("denominator").alias("denominator"),
        *(F.coalesce(F.sum(F.when(c, F.col("numerator"))), F.lit(0).cast(C.WIDE)).alias(f"{k}_n") for k, c in (("top", top), ("other", ~top))),
        *(F.count(F.when(c, 1)).alias(f"{k}_obs") for k, c in (("top", top), ("other", ~top))),
    )
    basis = F.substring_index("component", "_", -1)
    parts = F.array(F.struct(F.lit(f"_top_{n}_").alias("infix"), F.lit(f"Top {n}").alias("member"), F.col("top_n").alias("numerator"), F.col("top_obs").alias("observations")), F.struct(F.lit("_other_").alias("infix"), F.lit("Other").alias("member"), F.col("other_n").alias("numerator"), F.col("other_obs").alias("observations")))
    out = both.withColumn("basis", basis).select("*", F.explode(parts).alias("p"))
    return out.select(
        "contract_id", F.concat("dimension", "p.infix", "basis").alias("component"), "report_period", "correction_view", "grain", F.concat("dimension", F.lit("_summary")).alias("dimension"), "p.member",
        S.wide(F.col("p.numerator")).alias("numerator"), "denominator", "p.observations", S.safe_ratio(F.col("p.numerator"), F.col("denominator")).alias("value"), F.col("contract_id").isin(*C.CONTRACTS).alias("released"),
    )


def hhi(cube: DataFrame) -> DataFrame:
    """Sum of squared shares of each composition, by count and by balance; only the value means something."""
    by = _compositions(cube).groupBy("report_period", "dimension", "component").agg(F.sum("numerator").alias("total"), F.min("numerator").alias("least"), F.sum(F.col("numerator").cast("double") * F.col("numerator").cast("double")).alias("squares"), F.count("*").alias("n"))
    by = by.where("total > 0 and least >= 0")
    zero = F.lit(0).cast(C.WIDE)
    return by.select(
        F.lit("hhi_concentration").alias("contract_id"), F.concat("component", F.lit("_hhi")).alias("component"), "report_period", F.lit("latest").alias("correction_view"), F.lit("loan-period").alias("grain"), "dimension", F.lit("All").alias("member"),
        zero.alias("numerator"), F.lit(None).cast(C.WIDE).alias("denominator"), F.col("n").alias("observations"), (F.col("squares") / F.pow(F.col("total").cast("double"), F.lit(2.0))).alias("value"), F.lit("hhi_concentration" in C.CONTRACTS).alias("released"),
    )


THRESHOLDS = {"30_plus": ("30-59", "60-89", "90+"), "60_plus": ("60-89", "90+"), "90_plus": ("90+",)}


def threshold_rates(cube: DataFrame) -> DataFrame:
    """Loans at 30, 60 and 90 days and more among those whose days are known."""
    bands = cube.where("contract_id = 'delinquency_distribution'")
    known = F.col("member") != C.MISSING
    aggregates = []
    for basis in ("count", "upb"):
        own = F.col("component") == f"delinquency_band_{basis}"
        aggregates.append(F.coalesce(F.sum(F.when(own & known, F.col("numerator"))), F.lit(0).cast(C.WIDE)).alias(f"known_{basis}"))
        for label, members in THRESHOLDS.items():
            aggregates.append(F.coalesce(F.sum(F.when(own & F.col("member").isin(*members), F.col("numerator"))), F.lit(0).cast(C.WIDE)).alias(f"{label}_{basis}"))
    wide = bands.groupBy("report_period").agg(*aggregates)
    rows = [row("delinquency_threshold_rates", f"{label}_{b}", f"{label}_{b}", f"known_{b}", "known_count", "delinquency_threshold", label) for label in THRESHOLDS for b in ("count", "upb")]
    return tall(wide, rows, "latest", "loan-period")


def modification_rate(cube: DataFrame) -> DataFrame:
    """Loans with a disclosed program among active loans: one conditional pivot."""
    pick = lambda c: F.max(F.when(c, F.col("numerator")))
    base = (F.col("contract_id") == "current_outstanding_balance_population") & (F.col("dimension") == "portfolio")
    disclosed = (F.col("contract_id") == "modification_volume") & (F.col("member") == "Disclosed program")
    wide = cube.where(F.col("contract_id").isin("current_outstanding_balance_population", "modification_volume") & (F.col("grain") == "loan-period")).groupBy("report_period").agg(
        pick(base & (F.col("component") == "loan_count")).alias("n"), pick(base & (F.col("component") == "loan_upb")).alias("upb"),
        F.coalesce(pick(disclosed & (F.col("component") == "modification_count")), F.lit(0).cast(C.WIDE)).alias("mod_n"), F.coalesce(pick(disclosed & (F.col("component") == "modification_upb")), F.lit(0).cast(C.WIDE)).alias("mod_upb"),
    ).where("n is not null")
    return tall(wide, [row("modification_rate", "modification_count_rate", "mod_n", "n", "n"), row("modification_rate", "modification_upb_rate", "mod_upb", "upb", "n")], "latest", "loan-period")


# ---- securities


def is_active_security() -> Column:
    return _all(F.col("security_status") == "A", F.coalesce(F.col("current_upb_cents") > 0, F.lit(False)))


SECURITY_WEIGHTED = {
    **{f"security_{s}": ("credit_score_model_metrics", s, 1, "score_model", s) for s in C.SECURITY_SCORES},
    **{f"security_{r}": ("weighted_rates", r, 1000, "portfolio", "All") for r in C.SECURITY_RATES},
    **{f"security_{r}": (contract, r, 1, "portfolio", "All") for r, contract in C.SECURITY_RATIOS.items()},
}


def security_dimensions() -> dict[str, tuple[str, Column]]:
    return {
        "mission_density_score": ("mission_metrics", S.fixed_label(F.col("mission_density_score_centi"))),
        "mission_criteria_share": ("mission_metrics", S.fixed_label(F.col("mission_criteria_share_centi_pct"))),
        "mission_index_version": ("mission_metrics", _label("mission_index_version")),
        "green_indicator": ("green_social_eligibility", _label("green_indicator")),
        "social_indicator": ("green_social_eligibility", _label("social_indicator")),
    }


def _label(name: str) -> Column:
    return F.when(F.coalesce(F.col(name), F.lit("")) == "", C.MISSING).otherwise(F.col(name))


def security_cube(facts: DataFrame, view: str, only=None) -> DataFrame | None:
    """``facts``: one version of each security and period."""
    active, upb = is_active_security(), F.col("current_upb_cents")
    changed = F.col("correction_indicator") != "N"
    count = lambda c: F.count(F.when(c, 1))
    total = lambda c, x: F.coalesce(F.sum(F.when(c, S.wide(x))), F.lit(0).cast(C.WIDE))
    known_factor = active & F.col("factor_e8").isNotNull()
    floored = lambda name: F.greatest(F.col(name), F.lit(0))
    aggregates = [
        F.count("*").alias("rows"), count(active).alias("n"), total(active, upb).alias("upb"),
        total(known_factor, S.wide(upb) * F.col("factor_e8")).alias("factor_num"), total(known_factor, upb).alias("factor_den"),
        count(changed).alias("corrections"), total(changed, F.greatest(F.coalesce(upb, F.lit(0)), F.lit(0))).alias("correction_upb"),
        total(F.lit(True), floored("involuntary_removal_count")).alias("removed"), total(F.lit(True), floored("involuntary_removal_upb_cents")).alias("removed_upb"),
        count(F.col("involuntary_removal_count").isNull()).alias("removed_missing"), count(F.col("involuntary_removal_upb_cents").isNull()).alias("removed_upb_missing"),
        total(active, floored("loan_count")).alias("loans"), count(active & F.col("loan_count").isNull()).alias("loans_missing"),
    ]
    for name, (_, column, *_rest) in SECURITY_WEIGHTED.items():
        aggregates += _weighted(column, "current_upb_cents", active, name)
    wide = facts.groupBy("report_period").agg(*aggregates)
    rows = [
        row("current_outstanding_balance_population", "security_upb", "upb", None, "n"),
        row("current_outstanding_balance_population", "security_count", "n", None, "n"),
        row("security_size_distribution", "average_current_security_balance", "upb", "n", "n"),
        row("factor_level_change", "factor_level", "factor_num", "factor_den", "n", scale=100_000_000),
        row("correction_restatement_volume", "security_correction_count", "corrections", None, "rows"),
        row("correction_restatement_volume", "security_correction_upb", "correction_upb", None, "corrections"),
        row("involuntary_removal_volume", "involuntary_removal_count", "removed", None, "rows"),
        row("involuntary_removal_volume", "involuntary_removal_upb", "removed_upb", None, "rows"),
    ]
    for name, (contract, _, scale, dimension, member) in SECURITY_WEIGHTED.items():
        rows.append(row(contract, name, f"{name}_num", f"{name}_den", f"{name}_obs", dimension, member, when=F.col(f"{name}_obs") > 0, scale=scale))
    frames = [tall(wide, rows, view, "security-period", only)]
    if only is None or "involuntary_removal_share" in only:
        frames.append(removal_share(wide, view))
    if only is None or "factor_level_change" in only:
        frames.append(factor_change(facts, view))
    live = facts.where(active)
    seg = segments(live, security_dimensions(), "current_upb_cents", only)
    if seg is not None:
        frames.append(_segment_rows(seg, view, "security-period"))
    if only is None or "current_outstanding_balance_population" in only:
        prefix = segments(live, {"prefix": ("current_outstanding_balance_population", F.col("prefix"))}, "current_upb_cents")
        frames.append(_segment_rows(prefix, view, "security-period").withColumn("component", F.concat(F.lit("security_"), "component")))
    return union(frames)


def removal_share(wide: DataFrame, view: str) -> DataFrame:
    """Removals against the active population of the month just before; no denominator where an input is missing."""
    order = Window.orderBy("report_period")  # one row per month
    prior = lambda c: F.lag(c).over(order)
    wide = wide.withColumns({"near": S.adjacent(prior("report_period"), F.col("report_period")), "prior_loans": F.when((F.col("removed_missing") == 0) & (prior("loans_missing") == 0), prior("loans")), "prior_upb": F.when(F.col("removed_upb_missing") == 0, prior("upb"))})
    rows = [row("involuntary_removal_share", "involuntary_removal_count_share", "removed", "prior_loans", "rows", when=F.col("near")), row("involuntary_removal_share", "involuntary_removal_upb_share", "removed_upb", "prior_upb", "rows", when=F.col("near"))]
    return tall(wide, rows, view, "security-period")


def factor_change(facts: DataFrame, view: str) -> DataFrame:
    """Change of factor against the security's row before, if that is the month just before and both are active."""
    order = Window.partitionBy("security_id").orderBy("report_period")
    active = is_active_security()
    prior = facts.select("security_id", "report_period", "factor_e8", active.alias("active"), "current_upb_cents").withColumns({f"prior_{c}": F.lag(c).over(order) for c in ("report_period", "factor_e8", "active", "current_upb_cents")})
    use = prior.where(S.adjacent(F.col("prior_report_period"), F.col("report_period")) & F.col("active") & F.col("prior_active") & F.col("factor_e8").isNotNull() & F.col("prior_factor_e8").isNotNull() & (F.col("prior_current_upb_cents") > 0))
    wide = use.groupBy("report_period").agg(F.sum(S.wide(F.col("prior_current_upb_cents")) * (F.col("factor_e8") - F.col("prior_factor_e8"))).alias("num"), F.sum(S.wide(F.col("prior_current_upb_cents"))).alias("den"), F.count("*").alias("n"))
    return tall(wide, [row("factor_level_change", "factor_change", "num", "den", "n", scale=100_000_000)], view, "security-period")


def issuance_share(cube: DataFrame) -> DataFrame:
    """Issuance of a month against the latest book at its end."""
    issued = cube.where("contract_id = 'issuance_volume' and component = 'issuance_upb'").select("report_period", F.col("numerator").alias("issued"))
    book = cube.where("contract_id = 'current_outstanding_balance_population' and component = 'security_upb' and correction_view = 'latest'").select("report_period", F.col("numerator").alias("book"), "observations")
    return tall(issued.join(book, "report_period"), [row("new_issuance_share_ending_book", "issuance_share", "issued", "book", "observations")], "latest", "portfolio")
