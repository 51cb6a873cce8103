"""SQL of the metric cube by contract, written from the definitions and apart from the DataFrame plans."""

from __future__ import annotations

from .. import schemas as C
from .bindings import LOAN_CTE, PRODUCT_GROUP_SQL, SECURITY_CTE

_ACTIVE = "(join_reason = 'matched' AND correction_indicator <> 'D' AND coalesce(current_upb_cents, 0) > 0)"
_ACTIVE_SEC = "(security_status = 'A' AND coalesce(current_upb_cents, 0) > 0)"
_BAND = "CASE WHEN {d} IS NULL THEN 'Missing' WHEN {d} <= 0 THEN 'Current' WHEN {d} < 30 THEN '1-29' WHEN {d} < 60 THEN '30-59' WHEN {d} < 90 THEN '60-89' ELSE '90+' END"


def shaped(body: str, ctes: str = "") -> str:
    """The query's columns from rows of (contract_id, component, report_period, correction_view, grain, dimension, member, num, den, obs, value)."""
    return (
        f"WITH {ctes}, r AS ({body}) SELECT contract_id, component, report_period, correction_view, grain, dimension, member, CAST(CAST(num AS HUGEINT) AS VARCHAR) AS numerator, "
        "CAST(CAST(den AS HUGEINT) AS VARCHAR) AS denominator, CAST(obs AS BIGINT) AS observations, round(CAST(value AS DOUBLE), 10) AS value FROM r"
    )


def _row(contract, component, num, den, obs, frm, view="'latest'", grain="loan-period", dim="portfolio", member="'All'", scale=1, value=None, where="") -> str:
    v = value or (f"CASE WHEN ({den}) > 0 THEN CAST(({num}) AS DOUBLE) / CAST(({den}) AS DOUBLE) / {scale} END" if den != "NULL" else "NULL")
    return f"SELECT '{contract}' AS contract_id, '{component}' AS component, report_period, {view} AS correction_view, '{grain}' AS grain, '{dim}' AS dimension, {member} AS member, {num} AS num, {den} AS den, {obs} AS obs, {v} AS value FROM {frm} {where}"


def _seg(contract, dim, member, frm, upb="current_upb_cents", view="'latest'", grain="loan-period", prefix="") -> list[str]:
    inner = f"(SELECT report_period, {member} AS m, count(*) AS n, sum(CAST({upb} AS HUGEINT)) AS u FROM {frm} GROUP BY 1, 2)"
    out = []
    for basis, x in (("count", "n"), ("upb", "u")):
        total = f"sum({x}) OVER (PARTITION BY report_period)"
        out.append(_row(contract, f"{prefix}{dim}_{basis}", x, total, "n", inner, view, grain, dim, "m"))
    return out


_LOAN_ACTIVE = f"act AS (SELECT * FROM loan WHERE {_ACTIVE})"


def _weighted(contract, name, column, frm, view="'latest'", grain="loan-period", dim="portfolio", member="'All'", scale=1) -> str:
    use = f"(SELECT report_period, sum(CAST({column} AS HUGEINT) * current_upb_cents) AS a, sum(CAST(current_upb_cents AS HUGEINT)) AS b, count(*) AS c FROM {frm} WHERE {column} >= 0 GROUP BY 1)"
    return _row(contract, name, "a", "b", "c", use, view, grain, dim, member, scale)


def _loan_segments() -> dict[str, tuple[str, str]]:
    out = {d: (c, f"coalesce(nullif(trim(CAST({col} AS VARCHAR)), ''), 'Missing')") for d, (c, col) in C.LOAN_SEGMENTS.items()}
    out["mortgage_insurance_status"] = ("guarantee_mi_share", "CASE WHEN mortgage_insurance_pct IS NULL THEN 'Missing' WHEN mortgage_insurance_pct > 0 THEN 'Active coverage' WHEN mortgage_insurance_cancellation = 'Y' THEN 'Cancelled or expired' ELSE 'No disclosed MI' END")
    out["delinquency_band"] = ("delinquency_distribution", _BAND.format(d="days_delinquent"))
    out["modification"] = ("modification_volume", "CASE WHEN trim(coalesce(modification_program, '')) <> '' THEN 'Disclosed program' ELSE 'No disclosed program' END")
    return out


def _loan(contract: str) -> list[str]:
    every = "(SELECT report_period, count(*) AS n, count(CASE WHEN correction_indicator <> 'N' THEN 1 END) AS k, sum(CASE WHEN correction_indicator <> 'N' THEN greatest(coalesce(current_upb_cents, 0), 0) ELSE 0 END) AS ku FROM loan GROUP BY 1)"
    act = f"(SELECT report_period, count(CASE WHEN {_ACTIVE} THEN 1 END) AS n, sum(CASE WHEN {_ACTIVE} THEN current_upb_cents ELSE 0 END) AS u FROM loan GROUP BY 1)"
    cut = f"(SELECT report_period, sum(CASE WHEN {_ACTIVE} AND current_deferred_upb_cents >= 0 THEN current_deferred_upb_cents ELSE 0 END) AS d, sum(CASE WHEN {_ACTIVE} AND current_deferred_upb_cents >= 0 THEN current_upb_cents ELSE 0 END) AS u, count(CASE WHEN {_ACTIVE} AND current_deferred_upb_cents >= 0 THEN 1 END) AS n FROM loan GROUP BY 1)"
    fixed = {
        "current_outstanding_balance_population": [_row(contract, "loan_upb", "u", "NULL", "n", act), _row(contract, "loan_count", "n", "NULL", "n", act)],
        "loan_balance_distribution": [_row(contract, "average_current_loan_balance", "u", "n", "n", act)],
        "correction_restatement_volume": [_row(contract, "loan_correction_count", "k", "NULL", "n", every), _row(contract, "loan_correction_upb", "ku", "NULL", "k", every)],
        "deferred_upb_share": [_row(contract, "deferred_upb", "d", "NULL", "n", cut), _row(contract, "deferred_share", "d", "u", "n", cut)],
        "weighted_age_maturity": [_weighted(contract, "wala", "loan_age", "act"), _weighted(contract, "wam", "remaining_months_to_maturity", "act")],
        "weighted_rates": [_weighted(contract, r, r, "act", scale=1000) for r in C.LOAN_RATES],
    }
    out = list(fixed.get(contract, []))
    out += [_weighted(contract, r, r, "act") for r, c in C.LOAN_RATIOS.items() if c == contract]
    for dim, (c, member) in _loan_segments().items():
        if c == contract:
            out += _seg(contract, dim, member, "act")
    if contract == "credit_score_model_metrics":
        for s in C.LOAN_SCORES:
            out.append(_weighted(contract, s, s, "act"))
            own = f"(SELECT report_period, CAST({s} AS VARCHAR) AS m, count(*) AS n, sum(CAST(current_upb_cents AS HUGEINT)) AS u FROM act WHERE {s} IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT report_period, 'Missing', count(CASE WHEN coalesce({s}, -1) < 0 THEN 1 END), sum(CASE WHEN coalesce({s}, -1) < 0 THEN CAST(current_upb_cents AS HUGEINT) ELSE 0 END) FROM act GROUP BY 1)"
            for basis, x in (("count", "n"), ("upb", "u")):
                out.append(_row(contract, f"score:{s}_{basis}", x, f"sum({x}) OVER (PARTITION BY report_period)", "n", own, dim=f"score:{s}", member="m"))
    if contract in ("state_composition", "counterparty_composition"):
        for dim in ("state",) if contract == "state_composition" else ("seller", "servicer"):
            member = _loan_segments()[dim][1]
            for basis, x in (("count", "count(*)"), ("upb", "sum(CAST(current_upb_cents AS HUGEINT))")):
                ranked = f"(SELECT *, row_number() OVER (PARTITION BY report_period ORDER BY x DESC, m) AS k FROM (SELECT report_period, {member} AS m, {x} AS x FROM act GROUP BY 1, 2))"
                sums = f"(SELECT report_period, sum(x) AS t, sum(CASE WHEN k <= 10 THEN x ELSE 0 END) AS a, count(CASE WHEN k <= 10 THEN 1 END) AS an, sum(CASE WHEN k > 10 THEN x ELSE 0 END) AS b, count(CASE WHEN k > 10 THEN 1 END) AS bn FROM {ranked} GROUP BY 1)"
                out.append(_row(contract, f"{dim}_top_10_{basis}", "a", "t", "an", sums, dim=f"{dim}_summary", member="'Top 10'"))
                out.append(_row(contract, f"{dim}_other_{basis}", "b", "t", "bn", sums, dim=f"{dim}_summary", member="'Other'"))
    return out


_KEYS = "PARTITION BY report_period, security_id ORDER BY"
_VIEWS = (
    f"orig AS (SELECT 'original' AS view, * EXCLUDE (k) FROM (SELECT *, row_number() OVER ({_KEYS} as_of_timestamp, publication_date, source_id) AS k FROM sec WHERE quality_status = 'pass') WHERE k = 1), "
    f"late AS (SELECT 'latest' AS view, * EXCLUDE (k) FROM (SELECT *, row_number() OVER ({_KEYS} as_of_timestamp DESC, publication_date DESC, source_id DESC) AS k FROM sec WHERE quality_status = 'pass') WHERE k = 1), "
    f"sv AS (SELECT * FROM orig UNION ALL SELECT * FROM late), sa AS (SELECT * FROM sv WHERE {_ACTIVE_SEC})"
)
_IDX = "(CAST(substr({p}, 1, 4) AS INT) * 12 + CAST(substr({p}, 6, 2) AS INT))"


def _vrow(contract, component, num, den, obs, frm, dim="portfolio", member="'All'", scale=1, where="") -> str:
    return _row(contract, component, num, den, obs, frm, "view", "security-period", dim, member, scale, where=where)


def _security(contract: str) -> list[str]:
    a = _ACTIVE_SEC
    wide = (
        f"(SELECT view, report_period, count(*) AS n, count(CASE WHEN {a} THEN 1 END) AS an, sum(CASE WHEN {a} THEN current_upb_cents ELSE 0 END) AS u, "
        f"sum(CASE WHEN {a} AND factor_e8 IS NOT NULL THEN CAST(current_upb_cents AS HUGEINT) * factor_e8 ELSE 0 END) AS fa, sum(CASE WHEN {a} AND factor_e8 IS NOT NULL THEN current_upb_cents ELSE 0 END) AS fb, "
        "count(CASE WHEN correction_indicator <> 'N' THEN 1 END) AS k, sum(CASE WHEN correction_indicator <> 'N' THEN greatest(coalesce(current_upb_cents, 0), 0) ELSE 0 END) AS ku, "
        "sum(greatest(coalesce(involuntary_removal_count, 0), 0)) AS rc, sum(greatest(coalesce(involuntary_removal_upb_cents, 0), 0)) AS ru, count(*) - count(involuntary_removal_count) AS rcm, count(*) - count(involuntary_removal_upb_cents) AS rum, "
        f"sum(CASE WHEN {a} THEN greatest(coalesce(loan_count, 0), 0) ELSE 0 END) AS l, count(CASE WHEN {a} AND loan_count IS NULL THEN 1 END) AS lm FROM sv GROUP BY 1, 2)"
    )
    lagged = f"(SELECT *, lag(report_period) OVER w AS pp, lag(l) OVER w AS pl, lag(lm) OVER w AS plm, lag(u) OVER w AS pu FROM {wide} WINDOW w AS (PARTITION BY view ORDER BY report_period))"
    near = f"WHERE {_IDX.format(p='report_period')} - {_IDX.format(p='pp')} = 1"
    prior = f"(SELECT view, report_period, factor_e8 AS f, current_upb_cents AS u, {a} AS act, lag(report_period) OVER w AS pp, lag(factor_e8) OVER w AS pf, lag(current_upb_cents) OVER w AS pu, lag({a}) OVER w AS pact FROM sv WINDOW w AS (PARTITION BY view, security_id ORDER BY report_period))"
    change = f"(SELECT view, report_period, sum(CAST(pu AS HUGEINT) * (f - pf)) AS a, sum(CAST(pu AS HUGEINT)) AS b, count(*) AS n FROM {prior} {near} AND act AND pact AND f IS NOT NULL AND pf IS NOT NULL AND pu > 0 GROUP BY 1, 2)"
    fixed = {
        "current_outstanding_balance_population": [_vrow(contract, "security_upb", "u", "NULL", "an", wide), _vrow(contract, "security_count", "an", "NULL", "an", wide)],
        "security_size_distribution": [_vrow(contract, "average_current_security_balance", "u", "an", "an", wide)],
        "factor_level_change": [_vrow(contract, "factor_level", "fa", "fb", "an", wide, scale=100000000), _vrow(contract, "factor_change", "a", "b", "n", change, scale=100000000)],
        "correction_restatement_volume": [_vrow(contract, "security_correction_count", "k", "NULL", "n", wide), _vrow(contract, "security_correction_upb", "ku", "NULL", "k", wide)],
        "involuntary_removal_volume": [_vrow(contract, "involuntary_removal_count", "rc", "NULL", "n", wide), _vrow(contract, "involuntary_removal_upb", "ru", "NULL", "n", wide)],
        "involuntary_removal_share": [_vrow(contract, "involuntary_removal_count_share", "rc", "CASE WHEN rcm = 0 AND plm = 0 THEN pl END", "n", lagged, where=near), _vrow(contract, "involuntary_removal_upb_share", "ru", "CASE WHEN rum = 0 THEN pu END", "n", lagged, where=near)],
    }
    out = list(fixed.get(contract, []))

    def weighted(name, scale=1, dim="portfolio", member="'All'"):
        use = f"(SELECT view, report_period, sum(CAST({name} AS HUGEINT) * current_upb_cents) AS a, sum(CAST(current_upb_cents AS HUGEINT)) AS b, count(*) AS c FROM sa WHERE {name} >= 0 GROUP BY 1, 2)"
        return _vrow(contract, f"security_{name}", "a", "b", "c", use, dim, member, scale)

    if contract == "weighted_rates":
        out += [weighted(r, 1000) for r in C.SECURITY_RATES]
    out += [weighted(r) for r, c in C.SECURITY_RATIOS.items() if c == contract]
    if contract == "credit_score_model_metrics":
        out += [weighted(s, 1, "score_model", f"'{s}'") for s in C.SECURITY_SCORES]
    cents = "CASE WHEN {c} IS NULL THEN 'Missing' ELSE printf('%.2f', {c} / 100.0) END"
    text = "CASE WHEN coalesce({c}, '') = '' THEN 'Missing' ELSE {c} END"
    dims = {
        "mission_density_score": ("mission_metrics", cents.format(c="mission_density_score_centi")), "mission_criteria_share": ("mission_metrics", cents.format(c="mission_criteria_share_centi_pct")),
        "mission_index_version": ("mission_metrics", text.format(c="mission_index_version")), "green_indicator": ("green_social_eligibility", text.format(c="green_indicator")), "social_indicator": ("green_social_eligibility", text.format(c="social_indicator")),
        "prefix": ("current_outstanding_balance_population", "prefix"),
    }
    for dim, (c, member) in dims.items():
        if c == contract:
            inner = f"(SELECT view, report_period, {member} AS m, count(*) AS n, sum(CAST(current_upb_cents AS HUGEINT)) AS u FROM sa GROUP BY 1, 2, 3)"
            for basis, x in (("count", "n"), ("upb", "u")):
                out.append(_vrow(contract, ("security_" if dim == "prefix" else "") + f"{dim}_{basis}", x, f"sum({x}) OVER (PARTITION BY view, report_period)", "n", inner, dim, "m"))
    return out


_MONTHLY = "mon AS (SELECT report_period, count(*) AS n, sum(issuance_cents) AS u, round_even(median(issuance_cents), 0) AS md FROM sec GROUP BY 1)"


def _issuance(contract: str) -> list[str]:
    mk = lambda component, num, den, obs, frm="mon", dim="portfolio", member="'All'", where="": _row(contract, component, num, den, obs, frm, grain="issuance", dim=dim, member=member, where=where)
    if contract == "issuance_volume":
        return [mk("issuance_upb", "u", "NULL", "n"), mk("issued_security_count", "n", "NULL", "n")]
    if contract == "security_size_distribution":
        return [mk("average_issuance_security_size", "u", "n", "n"), mk("median_issuance_security_size", "md", "NULL", "n")]
    if contract == "issuance_product_mix":
        inner = f"(SELECT report_period, {PRODUCT_GROUP_SQL} AS m, count(*) AS n, sum(issuance_cents) AS u FROM sec GROUP BY 1, 2)"
        return [mk(f"group_{b}", x, f"sum({x}) OVER (PARTITION BY report_period)", "n", inner, "product_group", "m") for b, x in (("count", "n"), ("upb", "u"))]
    if contract == "period_change":
        out = []
        for k, label in ((1, "mom"), (3, "qoq"), (12, "yoy")):
            lag = f"(SELECT *, lag(report_period, {k}) OVER w AS pp, lag(n, {k}) OVER w AS pn, lag(u, {k}) OVER w AS pu FROM mon WINDOW w AS (ORDER BY report_period))"
            near = f"WHERE {_IDX.format(p='report_period')} - {_IDX.format(p='pp')} = {k}"
            out += [mk(f"issuance_{b}_{label}", f"{x} - p{x}", f"p{x}", "n", lag, where=near) for b, x in (("upb", "u"), ("count", "n"))]
        return out
    if contract == "rolling_issuance":
        out = []
        for w in (3, 6, 12):
            roll = f"(SELECT a.report_period, sum(b.n) AS n, sum(b.u) AS u FROM mon a JOIN mon b ON {_IDX.format(p='b.report_period')} BETWEEN {_IDX.format(p='a.report_period')} - {w - 1} AND {_IDX.format(p='a.report_period')} GROUP BY 1 HAVING count(*) = {w})"
            out += [mk(f"rolling_{w}_upb", "u", "NULL", "n", roll), mk(f"rolling_{w}_count", "n", "NULL", "n", roll)]
        return out
    return []


def _derived(contract: str) -> list[str]:
    if contract == "hhi_concentration":
        out = []
        for dim in ("state", "seller", "servicer"):
            member = _loan_segments()[dim][1]
            for basis, x in (("count", "count(*)"), ("upb", "sum(CAST(current_upb_cents AS HUGEINT))")):
                inner = f"(SELECT report_period, sum(CAST(x AS DOUBLE) * x) / (CAST(sum(x) AS DOUBLE) * CAST(sum(x) AS DOUBLE)) AS h, count(*) AS n FROM (SELECT report_period, {member} AS m, {x} AS x FROM act GROUP BY 1, 2) GROUP BY 1)"
                out.append(_row(contract, f"{dim}_{basis}_hhi", "0", "NULL", "n", inner, dim=dim, value="h"))
        return out
    if contract == "delinquency_threshold_rates":
        inner = "(SELECT report_period, count(days_delinquent) AS n, sum(CASE WHEN days_delinquent IS NOT NULL THEN current_upb_cents ELSE 0 END) AS u, " + ", ".join(f"count(CASE WHEN days_delinquent >= {d} THEN 1 END) AS n{d}, sum(CASE WHEN days_delinquent >= {d} THEN current_upb_cents ELSE 0 END) AS u{d}" for d in (30, 60, 90)) + " FROM act GROUP BY 1)"
        return [_row(contract, f"{d}_plus_{b}", f"{x}{d}", x, "n", inner, dim="delinquency_threshold", member=f"'{d}_plus'") for d in (30, 60, 90) for b, x in (("count", "n"), ("upb", "u"))]
    if contract == "modification_rate":
        mod = "trim(coalesce(modification_program, '')) <> ''"
        inner = f"(SELECT report_period, count(CASE WHEN {_ACTIVE} THEN 1 END) AS n, sum(CASE WHEN {_ACTIVE} THEN current_upb_cents ELSE 0 END) AS u, count(CASE WHEN {_ACTIVE} AND {mod} THEN 1 END) AS mn, sum(CASE WHEN {_ACTIVE} AND {mod} THEN current_upb_cents ELSE 0 END) AS mu FROM loan GROUP BY 1)"
        return [_row(contract, "modification_count_rate", "mn", "n", "n", inner), _row(contract, "modification_upb_rate", "mu", "u", "n", inner)]
    if contract == "new_issuance_share_ending_book":
        inner = f"(SELECT report_period, mon.u AS i, b.u AS u, b.n AS n FROM mon JOIN (SELECT report_period, count(CASE WHEN {_ACTIVE_SEC} THEN 1 END) AS n, sum(CASE WHEN {_ACTIVE_SEC} THEN current_upb_cents ELSE 0 END) AS u FROM late GROUP BY 1) b USING (report_period))"
        return [_row(contract, "issuance_share", "i", "u", "n", inner, grain="portfolio")]
    return []


_MANIFEST = (
    "man AS (SELECT report_period, source_family, min(schema_version) AS schema_version, count(*) AS input_count, count(CASE WHEN source_id % 30 <> 0 THEN 1 END) - count(CASE WHEN source_id % 60 = 1 THEN 1 END) AS accepted_count, "
    "count(CASE WHEN source_id % 60 = 1 THEN 1 END) AS excluded_count, count(CASE WHEN source_id % 60 = 0 THEN 1 END) AS rejected_count, count(CASE WHEN source_id % 60 = 30 THEN 1 END) AS duplicate_count FROM sec GROUP BY 1, 2), "
    "mf AS (SELECT *, rejected_count + duplicate_count AS quarantined_count, CASE WHEN rejected_count + duplicate_count > 0 THEN 'fail' ELSE 'pass' END AS quality_status, CASE WHEN rejected_count + duplicate_count > 0 THEN 0 ELSE accepted_count END AS published_count FROM man)"
)


def _trust(contract: str) -> list[str]:
    mk = lambda component, num, den, obs, frm="mf": _row(contract, component, num, den, obs, frm, grain="source", dim="source_family", member="source_family")
    if contract == "source_population_accounting":
        return [mk(f"{d}_count", f"{d}_count", "NULL", "input_count") for d in C.DISPOSITIONS]
    if contract == "source_disposition_rates":
        return [mk(f"{d}_rate", f"{d}_count", "input_count", "input_count") for d in C.DISPOSITIONS]
    if contract == "schema_transition_status":
        sets = f"(SELECT *, CASE WHEN {_IDX.format(p='report_period')} - {_IDX.format(p='pp')} = 1 AND v <> pv THEN 1 ELSE 0 END AS c FROM (SELECT *, lag(report_period) OVER w AS pp, lag(v) OVER w AS pv FROM (SELECT source_family, report_period, string_agg(DISTINCT schema_version, ',' ORDER BY schema_version) AS v, count(DISTINCT schema_version) AS n FROM mf GROUP BY 1, 2) WINDOW w AS (PARTITION BY source_family ORDER BY report_period)))"
        return [mk("schema_pass", "CASE WHEN quality_status = 'pass' THEN 1 ELSE 0 END", "1", "1"), mk("schema_transition_flag", "c", "1", "n", sets)]
    return []


def contract_sql(contract: str) -> str:
    rows = _loan(contract) + _security(contract) + _issuance(contract) + _derived(contract) + _trust(contract)
    ctes = ", ".join([SECURITY_CTE, LOAN_CTE, _LOAN_ACTIVE, _VIEWS, _MONTHLY, _MANIFEST])
    return shaped(" UNION ALL ".join(rows), ctes)


# ---- transitions: SQL for both views

_HIST = (
    "h AS (SELECT * FROM (SELECT view, source_family, loan_id, coalesce(security_id, '') AS sid, report_period, " + _IDX.format(p="report_period") + f" AS m, {_ACTIVE} AS act, coalesce(current_upb_cents, 0) AS u, days_delinquent AS d, trim(coalesce(modification_program, '')) <> '' AS md, "
    "row_number() OVER (PARTITION BY view, source_family, loan_id, coalesce(security_id, ''), report_period ORDER BY CASE WHEN view = 'original' THEN as_of_timestamp END, CASE WHEN view = 'original' THEN publication_date END, CASE WHEN view = 'original' THEN source_file END, CASE WHEN view = 'original' THEN source_row END, "
    "CASE WHEN view = 'latest' THEN as_of_timestamp END DESC, CASE WHEN view = 'latest' THEN publication_date END DESC, CASE WHEN view = 'latest' THEN source_file END DESC, CASE WHEN view = 'latest' THEN source_row END DESC) AS k "
    "FROM loan, (VALUES ('original'), ('latest')) AS v(view)) WHERE k = 1), per AS (SELECT DISTINCT report_period, m FROM h)"
)
_PAIRS = (
    "tr AS (SELECT p.view, n.report_period, " + _BAND.format(d="p.d") + " AS o, CASE WHEN c.m IS NULL OR NOT c.act OR c.d IS NULL THEN 'Attrition' ELSE " + _BAND.format(d="c.d") + " END AS t, count(*) AS n, sum(CAST(p.u AS HUGEINT)) AS u "
    "FROM h p JOIN per n ON n.m = p.m + 1 LEFT JOIN h c ON c.view = p.view AND c.source_family = p.source_family AND c.loan_id = p.loan_id AND c.sid = p.sid AND c.m = p.m + 1 WHERE p.act AND p.d IS NOT NULL GROUP BY 1, 2, 3, 4)"
)
_COHORT = (
    "st AS (SELECT c.view, c.source_family, c.loan_id, c.sid, c.report_period, c.m, c.u, g.trigger FROM h c JOIN h p ON p.view = c.view AND p.source_family = c.source_family AND p.loan_id = c.loan_id AND p.sid = c.sid AND p.m = c.m - 1, (VALUES ('cure'), ('modification')) AS g(trigger) "
    "WHERE c.act AND p.act AND CASE g.trigger WHEN 'cure' THEN p.d >= 30 AND c.d = 0 ELSE NOT p.md AND c.md END), "
    "fu AS (SELECT s.view, s.report_period, s.trigger, s.loan_id, s.sid, s.source_family, s.u, min(CASE WHEN x.act AND x.d >= 30 THEN x.m - s.m END) AS fb, list(CASE WHEN x.act AND x.d < 30 THEN x.m - s.m END) AS fine "
    "FROM st s LEFT JOIN h x ON x.view = s.view AND x.source_family = s.source_family AND x.loan_id = s.loan_id AND x.sid = s.sid AND x.m BETWEEN s.m + 1 AND s.m + 12 GROUP BY ALL), "
    "oc AS (SELECT *, CASE WHEN fb IS NOT NULL AND len(list_filter(fine, lambda q: q < fb)) = fb - 1 THEN 'redefault' WHEN fb IS NULL AND len(list_filter(fine, lambda q: q IS NOT NULL)) = 12 THEN 'complete' ELSE 'censored' END AS status FROM fu), "
    "sp AS (SELECT v.view, report_period, g.trigger FROM per, (VALUES ('original'), ('latest')) AS v(view), (VALUES ('cure'), ('modification')) AS g(trigger)), "
    "cw AS (SELECT sp.view, sp.report_period, sp.trigger, count(oc.status) AS an, coalesce(sum(oc.u), 0) AS au, count(CASE WHEN status = 'redefault' THEN 1 END) AS bn, coalesce(sum(CASE WHEN status = 'redefault' THEN oc.u END), 0) AS bu, "
    "count(CASE WHEN status <> 'censored' THEN 1 END) AS sn, coalesce(sum(CASE WHEN status <> 'censored' THEN oc.u END), 0) AS su, count(CASE WHEN status = 'censored' THEN 1 END) AS cn, coalesce(sum(CASE WHEN status = 'censored' THEN oc.u END), 0) AS cu "
    "FROM sp LEFT JOIN oc ON oc.view = sp.view AND oc.report_period = sp.report_period AND oc.trigger = sp.trigger GROUP BY 1, 2, 3)"
)


def transition_sql(contract: str) -> str:
    mk = lambda component, num, den, obs, frm, dim, member: _row(contract, component, num, den, obs, frm, "view", "loan-cohort", dim, member)
    if contract == "delinquency_roll_cure":
        rows = [mk(f"transition_{b}", x, f"sum({x}) OVER (PARTITION BY view, report_period, o)", "n", "tr", "delinquency_transition", "o || ' to ' || t") for b, x in (("count", "n"), ("upb", "u"))]
        rows.append(mk("eligible_origin_count", "n", "NULL", "n", "(SELECT view, report_period, sum(n) AS n FROM tr GROUP BY 1, 2)", "portfolio", "'All'"))
        return shaped(" UNION ALL ".join(rows), ", ".join([LOAN_CTE, _HIST, _PAIRS]))
    late = "t IN ('30-59', '60-89', '90+')"
    cur = f"(SELECT view, report_period, sum(CASE WHEN o = 'Current' THEN n ELSE 0 END) AS n, sum(CASE WHEN o = 'Current' THEN u ELSE 0 END) AS u, sum(CASE WHEN o = 'Current' AND {late} THEN n ELSE 0 END) AS ln, sum(CASE WHEN o = 'Current' AND {late} THEN u ELSE 0 END) AS lu FROM tr GROUP BY 1, 2)"
    rows = [mk(f"new_delinquency_{b}", f"l{x}", x, "n", cur, "delinquency_transition", "'Current to 30+'") for b, x in (("count", "n"), ("upb", "u"))]
    for b, x in (("count", "n"), ("upb", "u")):
        rows += [mk(f"trigger_cohort_{b}", f"a{x}", "NULL", "an", "cw", "redefault_trigger", "trigger"), mk(f"redefault_{b}", f"b{x}", f"s{x}", "sn", "cw", "redefault_trigger", "trigger"), mk(f"right_censored_{b}", f"c{x}", f"a{x}", "an", "cw", "redefault_trigger", "trigger")]
    return shaped(" UNION ALL ".join(rows), ", ".join([LOAN_CTE, _HIST, _PAIRS, _COHORT]))
