"""Archives to typed facts: golden rows, rejections, duplicates, joins, and a second run that changes nothing."""

import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import fields, population
from ledgerline.plans import conformance, parts
from ledgerline.sources import archives, contracts, provider_rules

SECURITY_HEADER = ["Prefix", "Security Identifier", "Security Factor Date", "Security Factor", "Security Data Correction Indicator", "Security Status Indicator", "Issuance Investor Security UPB", "Current Investor Security UPB"]
LOAN_HEADER = ["Loan Identifier", "Loan Correction Indicator", "Prefix", "Security Identifier", "Mortgage Loan Amount", "Issuance Investor Loan UPB", "Current Investor Loan UPB"]
ALIASES = {
    "security": dict(zip(("prefix", "security_id", "security_factor_date", "security_factor", "security_correction_indicator", "security_status", "issuance_security_upb", "current_security_upb"), ([h] for h in SECURITY_HEADER))),
    "loan": dict(zip(("loan_id", "loan_correction_indicator", "prefix", "security_id", "mortgage_loan_amount", "issuance_loan_upb", "current_loan_upb"), ([h] for h in LOAN_HEADER))),
}


def contract():
    family = lambda i, start, header: {"id": i, "pattern": rf"^{start}(?P<year>\d{{2}})(?P<month>\d{{2}})\d{{2}}\.zip$", "schema_versions": [{"version": "v1", "header_sha256": contracts.header_sha256(header), "column_count": len(header), "period_min": "2026-01", "period_max": "2026-12"}]}
    extra = {"id": "supplemental", "kind": "headerless", "pattern": r"^fq(?P<year>\d{2})(?P<month>\d{2})\d{2}\.zip$", "schema_versions": [{"version": "s1", "layouts": {"1": 2, "2": 3}}]}
    out = {"families": [family("monthly-security-core-1", "fd", SECURITY_HEADER), family("monthly-loan-level-1", "fu", LOAN_HEADER), extra]}
    contracts.validate(out)
    return out


def archive(folder, name, rows, header=None):
    with zipfile.ZipFile(folder / f"{name}.zip", "w") as z:
        z.writestr(f"{name}.txt", "\n".join("|".join(r) for r in ([header] if header else []) + rows) + "\n")


SECURITY_ROW = ["GLD", "GSEC01", "012026", "1", "N", "A", "100", "100"]
LOAN_ROW = ["GLOAN01", "N", "GLD", "GSEC01", "100", "100", "100"]


def changed(row, **cells):
    return [cells.get(f"c{i}", v) for i, v in enumerate(row)]


def load(spark, folder, work, **options):
    return conformance.load(spark, str(folder), contract(), ALIASES, str(work), **options)


def stop_at(step):
    def after(name):
        if name == step:
            raise KeyboardInterrupt

    return after


def test_golden_archives(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    archive(folder, "fd260107", [SECURITY_ROW, changed(SECURITY_ROW, c1="GSEC02", c3="", c7="-.5")], SECURITY_HEADER)
    archive(folder, "fu260107", [LOAN_ROW, changed(LOAN_ROW, c0="GLOAN02", c3=" "), changed(LOAN_ROW, c0="GLOAN03", c3="GONE"), changed(LOAN_ROW, c0="GLOAN04", c1="D")], LOAN_HEADER)
    archive(folder, "fq260107", [["1", "value-1"], ["2", "a", "b"]])
    found = load(spark, folder, tmp_path / "work", with_rules=False)
    manifest = {r.source_file: r for r in found.manifest.collect()}
    assert {k: (r.input_count, r.accepted_count, r.excluded_count, r.quality_status) for k, r in manifest.items()} == {"fd260107.zip": (2, 2, 0, "pass"), "fu260107.zip": (4, 4, 0, "pass"), "fq260107.zip": (2, 0, 2, "pass")}
    securities = {r.security_id: r for r in found.securities.collect()}
    assert (securities["GSEC01"].current_upb_cents, securities["GSEC01"].factor_e8) == (10000, 100000000) and (securities["GSEC02"].current_upb_cents, securities["GSEC02"].factor_e8) == (-50, None)
    assert securities["GSEC01"].publication_date == "2026-01-07" and securities["GSEC01"].as_of_timestamp == "2026-01-07T23:59:59Z" and securities["GSEC01"].v2_field_statuses == "-" * 14
    # 31 columns of facts besides the file's lineage.
    assert len(set(found.securities.columns) - {"source_file", "source_family", "schema_version", "publication_date", "as_of_timestamp"}) == 31
    assert {r.loan_id: r.join_reason for r in found.loans.collect()} == {"GLOAN01": "matched", "GLOAN02": "ineligible", "GLOAN03": "unmatched", "GLOAN04": "terminated"}
    assert population.unreconciled(found.manifest).count() == 0 and found.issues.count() == 0
    root = str(tmp_path / "out")
    conformance.write(found, root)
    before = {t: sorted(map(str, conformance.published(spark, root, t).collect())) for t in ("securities", "loans", "manifest", "join_counts")}
    conformance.write(load(spark, folder, tmp_path / "again", with_rules=False), root)
    assert before == {t: sorted(map(str, conformance.published(spark, root, t).collect())) for t in before}
    # A crash between tables, or within one, leaves what was there; the next run publishes all of it.
    for step in ("staged", "verified", "listed"):
        with pytest.raises(KeyboardInterrupt):
            conformance.write(found, root, stop_at(step))
        assert before == {t: sorted(map(str, conformance.published(spark, root, t).collect())) for t in before}
    short = conformance.Conformed(found.securities.limit(1), found.loans, found.manifest, found.issues, found.join_counts)
    with pytest.raises(parts.Refused, match="fd260107"):
        conformance.write(short, root)
    assert before == {t: sorted(map(str, conformance.published(spark, root, t).collect())) for t in before}


BAD_SECURITY = [
    (changed(SECURITY_ROW, c1=" "), "security business key is incomplete"), (changed(SECURITY_ROW, c2="132026"), "Security Factor Date is not MMCCYY"), (changed(SECURITY_ROW, c2="022026"), "Security Factor Date does not match publication period"),
    (changed(SECURITY_ROW, c4="D"), "Security Data Correction Indicator is invalid"), (changed(SECURITY_ROW, c5="X"), "Security Status Indicator is invalid"), (changed(SECURITY_ROW, c6="1.234"), "Issuance Investor Security UPB is not a valid decimal"),
    (changed(SECURITY_ROW, c7="9" * 25), "Current Investor Security UPB is not a valid decimal"), (SECURITY_ROW[:-1], "row width does not match approved schema"),
]
BAD_LOAN = [(changed(LOAN_ROW, c0=""), "loan business key is incomplete"), (changed(LOAN_ROW, c1="Q"), "Loan Correction Indicator is invalid"), (changed(LOAN_ROW, c4="malformed"), "Mortgage Loan Amount is not a valid decimal"), ([*LOAN_ROW, "x"], "row width does not match approved schema")]


def test_sources_fail_as_a_whole(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    archive(folder, "fd260107", [SECURITY_ROW, *(r for r, _ in BAD_SECURITY), SECURITY_ROW], SECURITY_HEADER)
    archive(folder, "fu260107", [LOAN_ROW, *(r for r, _ in BAD_LOAN)], LOAN_HEADER)
    archive(folder, "fd260207", [changed(SECURITY_ROW, c2="022026")], SECURITY_HEADER)
    archive(folder, "fq260107", [["1", "value-1"], ["3", "a"]])
    found = load(spark, folder, tmp_path / "work", with_rules=False)
    issues = {(r.source_file, r.source_row): (r.code, r.detail) for r in found.issues.collect()}
    for name, bad, code in (("fd260107.zip", BAD_SECURITY, "INVALID_SECURITY_ROW"), ("fu260107.zip", BAD_LOAN, "INVALID_LOAN_ROW")):
        assert [issues[name, i] for i in range(3, 3 + len(bad))] == [(code, message) for _, message in bad]
    assert issues["fd260107.zip", 3 + len(BAD_SECURITY)] == ("DUPLICATE_KEY", "duplicate key")
    manifest = {r.source_file: r for r in found.manifest.collect()}
    assert "fq260107.zip" not in manifest  # an unknown record type: the inventory blocks the file
    r = manifest["fd260107.zip"]
    assert (r.accepted_count, r.rejected_count, r.duplicate_count, r.published_count, r.quality_status) == (1, len(BAD_SECURITY), 1, 0, "fail")
    assert [x.report_period for x in found.securities.collect()] == ["2026-02"] and found.loans.count() == 0


# ---- field rules: a valid and an invalid text for each, and the row class where one is needed

CASES = {
    "security": (
        "issue_date 01012025 01022025", "maturity_date 012050 132050", "wa_net_interest_rate 5.125 5.1234", "wa_issuance_interest_rate 5.125 bad", "wa_current_interest_rate 5.125 bad", "wa_ltv 95 bad", "wa_cltv 100 bad", "wa_dti 36 bad",
        "wa_eltv 90 bad reperforming", "mission_density_score 1.25 bad", "mission_criteria_share 80.00 bad", "green_indicator Y X", "social_indicator N X", "mission_index_version V1.1 V2.0",
    ),
    "loan": (
        "original_interest_rate 5.125 bad", "issuance_interest_rate 5.125 bad", "current_interest_rate 5.125 bad", "issuance_net_interest_rate 4.875 bad", "current_net_interest_rate 4.875 bad", "first_payment_date 022025 132025", "maturity_date 012055 132055",
        "ltv 95 bad", "cltv 100 bad", "dti 36 bad", "first_time_homebuyer Y X", "loan_purpose P X", "occupancy_status P X", "number_of_units 2 bad", "property_type SF XX", "channel R X", "mortgage_insurance_percent 25 bad", "mortgage_insurance_cancellation N X",
        "government_insured_guarantee FH XX", "modification_type F X modified-fixed-rate", "number_of_modifications 2 -1 modified-fixed-rate", "total_capitalized_amount 1500.00 -1 modified-fixed-rate", "original_deferred_amount 500.00 -1 modified-fixed-rate",
        "eltv 90 bad reperforming", "origination_first_payment_date 022020 132020 reperforming", "alternative_resolution P X", "alternative_resolution_count 2 100", "total_deferral_amount 500.00 -1", "borrower_assistance_plan F X", "special_eligibility_program H X",
    ),
    "acquisition": ("acquired_at 2026-01-07T23:59:59Z 2026-01-07T23:59:59-06:00",),
}
RULES = {"security": provider_rules.SECURITY_RULES, "loan": provider_rules.LOAN_RULES, "acquisition": provider_rules.ACQUISITION_RULES}


@pytest.mark.parametrize("kind", list(CASES))
def test_every_field_has_a_rule(spark, kind):
    rules = {r["target"]: r for r in RULES[kind]}
    cases = [c.split() for c in CASES[kind]]
    assert [c[0] for c in cases] == list(rules) and len(rules) == {"security": 14, "loan": 30, "acquisition": 1}[kind]
    columns, want = [], []
    for target, valid, invalid, *row_class in cases:
        rule = rules[target]
        classes = F.lit(row_class[0] if row_class else "standard")
        add = lambda status, text, c=classes, indicator="N", r=rule: (columns.append(fields.validated(r, F.lit(text), c, F.lit(indicator))["status"].alias(f"c{len(columns)}")), want.append((r["target"], text, status)))
        add("valid", valid)
        add("error", invalid)
        add("error", valid, indicator="?")
        add("null" if rule.get("nullable", True) else "error", "")
        for code in rule.get("valid_values", ()):
            add("valid", code)
        for text, meaning in rule.get("sentinels", ()):
            add(meaning, text)
        if rule.get("range"):
            limits = rule["range"]
            add("valid", str(limits["min"]))
            add("valid", str(limits["max"]))
            add("not_available" if limits.get("out_of_range_action") == "not_available" else "error", str(limits["max"] + 1) if (str(limits["max"] + 1), "not_available") not in rule.get("sentinels", ()) else str(limits["min"] - 1))
        if rule.get("row_classes"):
            add("not_applicable", "", F.lit("standard"))
            add("error", valid, F.lit("standard"))
    found = spark.range(1).select(*columns).first()
    assert [(t, text, s) for (t, text, _), s in zip(want, found)] == want


def test_prefixes_prohibit_fields(spark):
    prefixes = [p for ps in provider_rules.PREFIX_CLASSES.values() for p in ps]
    assert len(prefixes) == len(set(prefixes))
    rule = next(r for r in provider_rules.LOAN_RULES if r["target"] == "current_interest_rate")
    df = spark.createDataFrame([("1A", ""), ("1A", "99.999"), ("1A", "5.125"), ("CL", "5.125"), ("MA", "5.125")], "prefix string, x string")
    c = provider_rules.row_class(F.col("prefix"))
    out = [(r.v.status, r.v.error) for r in df.select(fields.validated(rule, F.col("x"), c, F.lit("N"), c.isin("arm")).alias("v")).collect()]
    assert [s for s, _ in out] == ["not_applicable", "not_available", "error", "valid", "valid"] and "prohibited" in out[2][1]


def test_lines_of_a_store_that_only_spark_reads(spark, tmp_path, monkeypatch):
    archive(tmp_path, "fd260107", [SECURITY_ROW] * 3, SECURITY_HEADER)
    archive(tmp_path, "fd260207", [SECURITY_ROW], SECURITY_HEADER)
    (tmp_path / "fd260307.zip").write_bytes(b"not a zip")
    read = lambda: sorted(map(str, archives.zip_lines(spark, str(tmp_path)).collect()))
    streamed = read()
    monkeypatch.setattr(archives, "_reachable", lambda path: False)
    assert read() == streamed and len(streamed) == 7


def test_stored_facts_hold_what_is_read(spark):
    """Of the lines' facts only what a query reads is written, joined loans not at all; rows and verdicts stay the same."""
    from ledgerline import queries
    from ledgerline.plans import bindings

    sf, widths = "/root/testdata/sf0.001", []
    lines = bindings.archive_lines(spark, sf)
    assert lines.where("line = 1").groupBy("file").count().where("count != 1").isEmpty()
    assert lines.groupBy("file").agg(F.max("line").alias("last"), F.count("*").alias("n")).where("last != n").isEmpty()
    files, keep = archives.inventory(lines, bindings.archive_contract()), lambda f: widths.append(len(f.columns)) or f
    whole = conformance.conform(lines, files, bindings.ARCHIVE_ALIASES, keep=keep)
    most, n = max(widths), len(widths)
    widths.clear()
    cut = conformance.conform(lines, files, bindings.ARCHIVE_ALIASES, keep=keep, columns={"loan": queries.CONFORMED_LOAN}, loans_read_once=True)
    assert len(widths) == n - 1 and max(widths) < most / 2
    a, b = (f.loans.select(*queries.CONFORMED_LOAN) for f in (whole, cut))
    assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_lines_are_numbered_in_slices(spark, tmp_path, monkeypatch):
    """A file's rows are numbered by several tasks, as one order of all of them would."""
    from pyspark.sql import Window

    from ledgerline.plans import bindings

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(bindings, "SLICE", 1_500)
    lines = bindings.archive_lines(spark, sf, str(tmp_path / "lines"))
    assert max(r.n for r in spark.read.option("mergeSchema", True).parquet(f"{tmp_path}/lines/*").where("slice is not null").groupBy("file").agg(F.count_distinct("slice").alias("n")).collect()) > 1
    for source, columns in ((spark.read.parquet(f"{sf}/orders.parquet"), bindings.SECURITY_LINES), (bindings._loan_rows(spark, sf).join(spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus"), "o_orderkey"), bindings.LOAN_LINES)):
        value = F.concat_ws("|", *(F.col(f"`{n}`") for n in columns if n not in ("file", "row_key")))
        rows = bindings._select(source, columns).select("file", "row_key", value.alias("value"))
        plain = rows.select(F.concat("file", F.lit(".zip")).alias("file"), (F.row_number().over(Window.partitionBy("file").orderBy("row_key", "value")) + 1).cast("long").alias("line"), "value")
        own = lines.where("line > 1").join(plain.select("file").distinct(), "file", "left_semi").select("file", "line", "value")
        assert own.count() == plain.count() > 0 and own.exceptAll(plain).isEmpty()


def test_only_hashes_of_keys_are_dealt(spark):
    """Keys themselves are shuffled of rows whose hash occurs again; nulls are a key like any other."""
    rows = [("2020-01", f"L{i % 90}", None if i % 3 == 0 else "S", "f", "a", i, None if i % 10 else "bad") for i in range(120)]
    facts = spark.createDataFrame(rows, "report_period string, loan_id string, security_id string, source_family string, source_file string, source_row long, error string")
    kept = []
    found = conformance.dispositions(facts, conformance.LOAN, lambda f: kept.append(f.collect()) or f).collect()
    assert [len(k) for k in kept] == [27, 27] and kept[0][0].asDict().keys() == {"key_hash"}
    seen, expected = set(), {}
    for r in rows:
        expected[r[5]] = "rejected" if r[6] else "duplicate" if r[:3] in seen else "accepted"
        seen |= set() if r[6] else {r[:3]}
    assert {r.source_row: r.disposition for r in found} == expected


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unsized(spark):
    """Joins as for tables whose size Spark does not take for small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_lines_stay_where_they_are(spark, tmp_path, unsized, monkeypatch):
    """Files' places and lineage come to the lines, of either kind; with too many files for that, rows are the same."""
    archive(tmp_path, "fd260107", [SECURITY_ROW, SECURITY_ROW], SECURITY_HEADER)
    archive(tmp_path, "fu260107", [LOAN_ROW], LOAN_HEADER)
    keep = lambda f: archives.stored(f, str(tmp_path / "kept"))
    lines = keep(archives.zip_lines(spark, str(tmp_path)))
    files = keep(archives.inventory(lines, contract()))
    read = lambda kind: conformance.raw_rows(lines, files, kind, ALIASES[kind.name])
    for kind, n in ((conformance.SECURITY, 2), (conformance.LOAN, 1)):
        rows = read(kind)
        top = plan_of(rows).split("BroadcastExchange")[0]
        assert "BroadcastHashJoin" in top and "hashpartitioning" not in top and rows.count() == n
        with monkeypatch.context() as m:
            m.setattr(conformance, "FEW", 0)
            assert sorted(map(str, read(kind).collect())) == sorted(map(str, rows.collect()))


def test_many_duplicates_of_few_keys(spark, tmp_path, unsized, monkeypatch):
    """However many rows share a key, facts are not shuffled to mark them; many such keys give the same verdicts."""
    rows = [("2020-01", f"L{i % 3 if i < 60 else i}", None if i % 3 == 0 else "S", "f", f"{i % 2}", 100 - i, None if i % 10 else "bad") for i in range(90)]
    facts = spark.createDataFrame(rows, "report_period string, loan_id string, security_id string, source_family string, source_file string, source_row long, error string")
    want, seen = {}, set()
    for r in sorted(rows, key=lambda r: r[3:6]):
        want[r[4:6]] = "rejected" if r[6] else "duplicate" if r[:3] in seen else "accepted"
        seen |= set() if r[6] else {r[:3]}
    assert list(want.values()).count("duplicate") > 40
    for most, dealt in ((5, False), (2, True)):
        monkeypatch.setattr(conformance, "FEW", most)
        out = conformance.dispositions(facts, conformance.LOAN, lambda f: archives.stored(f, str(tmp_path / "kept")))
        assert ("hashpartitioning" in plan_of(out)) == dealt
        assert {(r.source_file, r.source_row): r.disposition for r in out.collect()} == want


def test_lines_are_dealt_as_numbers(spark, tmp_path, monkeypatch):
    """The text of a line is made after rows were dealt to their slices."""
    from ledgerline.plans import bindings

    made, staged = [], bindings.release.staged
    monkeypatch.setattr(bindings.release, "staged", lambda frame, folder: made.append(plan_of(frame)) or staged(frame, folder))
    bindings.archive_lines(spark, "/root/testdata/sf0.001", str(tmp_path / "lines"))
    lines = [p for p in made if "concat_ws" in p]
    assert len(lines) == 2
    for plan in lines:
        above, below = plan.split("Exchange hashpartitioning(file", 1)
        assert "concat_ws" in above and "concat_ws" not in below


def test_checks_run_compiled(spark, tmp_path):
    """Facts are stored by plans whose methods the JVM compiles, without what manifests know of a file; the session's own
    setting stays, and published rows have all columns."""
    archive(tmp_path, "fd260107", [SECURITY_ROW], SECURITY_HEADER)
    archive(tmp_path, "fu260107", [LOAN_ROW, changed(LOAN_ROW, c0="GLOAN02", c3="GONE")], LOAN_HEADER)
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before, keep = spark.conf.get(name), lambda f: seen.append((f.columns, spark.conf.get(name))) or archives.stored(f, str(tmp_path / "kept"))
    lines = keep(archives.zip_lines(spark, str(tmp_path)))
    found = conformance.conform(lines, keep(archives.inventory(lines, contract())), ALIASES, keep=keep)
    facts = [(columns, limit) for columns, limit in seen if {"source_row", "record_hash", "error"} <= set(columns)]
    assert [limit for _, limit in facts] == ["8000"] * 2 and not any(set(conformance.OF_FILE) & set(columns) for columns, _ in facts)
    assert spark.conf.get(name) == before and {limit for columns, limit in seen if "record_hash" not in columns} == {before}
    assert set(conformance.LINEAGE) < set(found.loans.columns) & set(found.securities.columns)
    assert {(r.loan_id, r.schema_version, r.publication_date, r.as_of_timestamp, r.join_reason) for r in found.loans.collect()} == {(i, "v1", "2026-01-07", "2026-01-07T23:59:59Z", reason) for i, reason in (("GLOAN01", "matched"), ("GLOAN02", "unmatched"))}


def test_blank_cells_cost_a_letter(spark):
    """Rules of cells that no header has: the letter that the whole rule gives, for every class of rows."""
    classes = ["standard", "reperforming", *provider_rules.PREFIX_CLASSES]
    df = spark.createDataFrame([(c,) for c in classes], "c string")
    pairs = []
    for kind in (conformance.SECURITY, conformance.LOAN):
        for rule in kind.rules:
            names = provider_rules.PROHIBITED[kind.name].get(rule["target"])
            prohibited = F.col("c").isin(*names) if names else None
            pairs.append(F.struct(fields.letter(fields.validated(rule, F.lit(""), F.col("c"), F.lit("N"), prohibited)["status"]).alias("a"), fields.blank_letter(rule, F.col("c"), prohibited).alias("b")))
    rows = df.select(*pairs).collect()
    assert len(rows) == 6 and all(p.a == p.b for r in rows for p in r) and {p.b for r in rows for p in r} == {"0", "A"}
    assert fields.blank_letter(conformance.LOAN.rules[0] | {"nullable": False}) is None


def test_wrong_corrections_spoil_all_statuses(spark, tmp_path):
    """A row with a wrong correction has no sound field, and is rejected for the correction."""
    archive(tmp_path, "fu260107", [LOAN_ROW, changed(LOAN_ROW, c1="Q")], LOAN_HEADER)
    lines = archives.stored(archives.zip_lines(spark, str(tmp_path)), str(tmp_path / "lines"))
    files = archives.inventory(lines, contract())
    own = ALIASES["loan"] | {"original_interest_rate": ["Mortgage Loan Amount"]}
    rows = conformance.typed(conformance.raw_rows(lines, files, conformance.LOAN, own), conformance.LOAN, own).orderBy("source_row").collect()
    assert [r.error for r in rows] == [None, "Loan Correction Indicator is invalid"] and [r.original_interest_rate_milli_pct for r in rows] == [100000, None]
    assert rows[0].v2_field_statuses[0] == "V" and rows[1].v2_field_statuses == "?" * 30 and "A" in rows[0].v2_field_statuses


def test_scaled_text(spark):
    """Odd forms of numbers, line ends that patterns let pass included, with and without knowing that they are sound."""
    from ledgerline.functions import scalars as S

    want = {"": None, "-": 0, ".": 0, "-.": 0, ".5": 50, "-.5": -50, "5.": 500, "-0": 0, "007.1": 710, " 12 ": 1200, "9" * 16: int("9" * 16 + "00"), "0" * 9 + "9" * 16 + ".99": int("9" * 18), "5\u0085": 500, "5.2\u0085": 520, "9" * 17: None, "1.234": None, "+5": None, "5 5": None, "x": None, None: None}
    df = spark.createDataFrame([(t,) for t in want], "x string")
    x = F.col("x")
    assert {r.x: (r.a, r.b) for r in df.select("x", S.parse_scaled(x, 2).alias("a"), S.parse_scaled(x, 2, S.is_scaled(x, 2)).alias("b")).collect()} == {t: (v, v) for t, v in want.items()}
    whole = {"": None, "+5": 5, "-5": -5, " 7 ": 7, "0" * 20 + "1": 1, "9" * 18: int("9" * 18), "1" * 19: int("1" * 19), "9" * 20: None, "5.": None, "5\u0085": None, "x": None, None: None}
    df = spark.createDataFrame([(t,) for t in whole], "x string")
    assert {r.x: (r.a, r.b) for r in df.select("x", S.parse_integer(x).alias("a"), S.parse_integer(x, S.is_integer(x)).alias("b")).collect()} == {t: (v, v) for t, v in whole.items()}


def test_loans_are_sorted_by_their_ids(spark, unsized):
    """The join sorts by ids before the places that loans without one are dealt to."""
    loans = spark.createDataFrame([("L1", 1, "S1", "2020-01", "N"), ("L2", 2, None, "2020-01", "N"), ("L3", 3, "S1", "2020-02", "N"), ("L4", 4, "S2", "2020-01", "D")], "loan_id string, source_row long, security_id string, report_period string, correction_indicator string")
    securities = spark.createDataFrame([("S1", "2020-01", "A"), ("S2", "2020-01", "A")], "security_id string, report_period string, security_status string")
    out = population.join_reason(loans, securities)
    assert "Sort [security_id" in plan_of(out) and "hashpartitioning(security_id" in plan_of(out)
    assert {r.loan_id: r.join_reason for r in out.collect()} == {"L1": "matched", "L2": "ineligible", "L3": "unmatched", "L4": "terminated"}
