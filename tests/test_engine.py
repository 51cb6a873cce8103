import hashlib
import os
import random
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import fields, population
from ledgerline.plans import cube, issuance, parts, release, transitions
from ledgerline.sources import archives, contracts


def values(spark, kind, rows, expression):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}").orderBy("i").select(expression).collect()]


def test_scaled_text(spark):
    raw = ["1.25", "-3", ".5", "-", ".", "1.234", "+1", "1e2", "", None, " 7 ", "1.2.3"]
    assert values(spark, "string", raw, S.parse_scaled(F.col("x"), 2)) == [125, -300, 50, 0, 0, None, None, None, None, None, 700, None]
    assert values(spark, "string", raw, S.is_scaled(F.col("x"), 2)) == [True, True, True, True, True, False, False, False, True, None, True, False]


def test_bands_and_events(spark):
    assert values(spark, "int", [None, -1, 0, 1, 29, 30, 60, 90], S.delinquency_band(F.col("x"))) == ["Missing", "Current", "Current", "1-29", "1-29", "30-59", "60-89", "90+"]
    pairs = [(None, 0), (30, None), (30, 0), (0, 30), (5, 6), (5, 40), (40, 5), (0, 0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a int, b int").orderBy("i")
    assert [r[0] for r in df.select(S.transition_event(F.col("a"), F.col("b"))).collect()] == ["ineligible", "attrition", "cure", "new_delinquency", "stable", "worsening", "improvement", "stable"]


def test_month_arithmetic(spark):
    df = spark.createDataFrame([("2024-12", "2025-01"), ("2024-12", "2025-02")], "a string, b string")
    assert [r[0] for r in df.select(S.adjacent(F.col("a"), F.col("b"))).collect()] == [True, False]
    assert [r[0] for r in df.select(S.within_months(F.col("a"), F.col("b"), 1)).collect()] == [True, False]


def test_smm_cpr(spark):
    df = spark.createDataFrame([(1.0, 100.0)], "a double, b double")
    assert df.select(S.cpr(S.smm(F.col("a"), F.col("b")))).first()[0] == pytest.approx(1 - 0.99**12)


RULE = {"target": "x", "type": "decimal", "scale": 2, "nullable": False, "max_length": 6, "sentinels": [("999", "not_available")], "range": {"min": 0, "max": 10, "out_of_range_action": "error"}, "row_classes": ["modified"]}


def test_field_rule_order(spark):
    raw = [("1.5", "modified"), ("", "modified"), ("999", "modified"), ("1.555", "modified"), ("x", "modified"), ("11", "modified"), ("1.5", "standard"), ("", "standard"), ("1234567", "modified"), ("1.5", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(raw)], "i int, x string, c string").orderBy("i").select(fields.validated(RULE, F.col("x"), F.col("c")).alias("v"))
    out = [(r.v.status, r.v.value, r.v.error) for r in df.collect()]
    assert [s for s, _, _ in out] == ["valid", "error", "not_available", "error", "error", "error", "error", "not_applicable", "error", "error"]
    assert out[1][2] == "x is required" and out[3][2] == "x exceeds approved scale" and out[5][2] == "x is outside its approved range" and out[8][2] == "x exceeds max length"


def test_field_rule_contracts():
    for bad in ({"type": "money"}, {"type": "enum"}, {"type": "decimal"}, {"type": "date", "raw_format": "YY"}, {"type": "integer", "range": {"min": 2, "max": 1}}):
        with pytest.raises(fields.RuleError):
            fields.validate_rule({"target": "x"} | bad)


def test_join_reasons(spark):
    securities = spark.createDataFrame([("2024-01", "A", "A"), ("2024-01", "B", "A"), ("2024-01", "B", "A"), ("2024-01", "T", "P"), ("2024-03", "L", "A")], "report_period string, security_id string, security_status string")
    loans = spark.createDataFrame([("2024-01", "A", "N", "matched"), ("2024-01", "B", "N", "ambiguous"), ("2024-01", "T", "N", "terminated"), ("2024-01", "A", "D", "terminated"), ("2024-01", None, "N", "ineligible"), ("2024-01", None, "D", "terminated"), ("2024-01", "L", "N", "late"), ("2024-04", "L", "N", "unmatched"), ("2024-01", "X", "N", "unmatched")], "report_period string, security_id string, correction_indicator string, expected string")
    out = population.join_reason(loans, securities)
    assert out.count() == 9 and out.where("join_reason != expected").count() == 0


def test_dispositions_fail_closed(spark):
    row = ("2024-01", "S1", "CL", "A", 100.0, 50.0, 0.5, 0.0, 1, 1, 0, "f", 1)
    names = "report_month security_id security_type security_status issuance_upb current_upb security_factor cpr_pct published_files expected_files publication_lag_days source_file source_row".split()
    change = lambda **k: tuple(k.get(n, v) for n, v in zip(names, row))
    rows = [row, change(source_row=2), change(security_id="S2", current_upb=200.0, source_row=3), change(security_id="S3", issuance_upb=None, current_upb=None, security_factor=None, security_status="C", source_row=4), change(security_id="S4", issuance_upb=None, source_row=5)]
    df = spark.createDataFrame(rows, "report_month string, security_id string, security_type string, security_status string, issuance_upb double, current_upb double, security_factor double, cpr_pct double, published_files int, expected_files int, publication_lag_days int, source_file string, source_row int")
    out = population.dispositions(df, ["report_month", "security_id"], [F.col("source_file"), F.col("source_row")])
    assert [r.disposition for r in out.orderBy("source_row").collect()] == ["accepted", "duplicate", "rejected", "excluded", "rejected"]
    m = population.manifest(out, ["source_file"])
    r = m.first()
    assert (r.input_count, r.accepted_count, r.excluded_count, r.rejected_count, r.duplicate_count, r.published_count, r.quality_status) == (5, 1, 1, 2, 1, 0, "fail")
    assert population.unreconciled(m).count() == 0


def loop_outcomes(states, threshold=30, window=12):
    """The cohort rules told month by month."""
    out = {}
    by: dict = {}
    for key, month, active, days, modified in states:
        by.setdefault(key, {})[month] = (active, days, modified)
    for key, months in by.items():
        for m, (active, days, modified) in months.items():
            before = months.get(m - 1)
            if not (before and before[0] and active):
                continue
            kinds = [k for k, hit in (("cure", before[1] is not None and before[1] >= threshold and days == 0), ("modification", not before[2] and modified)) if hit]
            status = "censored"
            for step in range(1, window + 1):
                a, d, _ = months.get(m + step, (False, None, False))
                if a and d is not None and d >= threshold:
                    status = "redefault"
                    break
                if not a or d is None:
                    break
                if step == window:
                    status = "complete"
            for k in kinds:
                out[key, m, k] = status
    return out


def test_cohorts_like_the_loop(spark):
    rng = random.Random(3)
    states = []
    for key in range(300):
        start = rng.randrange(3)
        for m in range(start, start + rng.randrange(2, 22)):
            if rng.random() < 0.95:
                states.append((f"K{key}", m, rng.random() < 0.97, rng.choice([0, 0, 0, 0, 0, 0, 10, 35, None if rng.random() < 0.3 else 0]), rng.random() < 0.2))
    df = spark.createDataFrame([("f", k, "s", f"{2020 + m // 12}-{m % 12 + 1:02d}", 2020 * 12 + m + 1, a, 100, d, x) for k, m, a, d, x in states], "source_family string, loan_id string, security_id string, report_period string, month int, active boolean, upb long, days int, modified boolean")
    found = {(r.loan_id, int(r.report_period[:4]) * 12 + int(r.report_period[5:]) - 1 - 2020 * 12, r.trigger): r.status for r in transitions.cohorts(df).collect()}
    expected = loop_outcomes(states)
    assert found == expected and set(expected.values()) == {"redefault", "complete", "censored"}


def test_batches_are_written_once(spark, tmp_path):
    from ledgerline.streaming import events

    path = str(tmp_path / "p")
    for batch_id, rows in ((0, [(1,)]), (1, [(2,), (3,)]), (1, [(2,), (3,)])):
        events.write_batch(path, spark.createDataFrame(rows, "n int"), batch_id)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_duplicates_of_a_stream_go(spark, tmp_path):
    from ledgerline.streaming import events

    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:10:00"), ("b", "2024-01-01 00:20:00")]
    spark.createDataFrame(rows, "k string, ts string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, ts string").parquet(str(tmp_path / "in"))
    q = events.first_of_key(stream, ["k"]).writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.k for r in spark.table("firsts").collect()) == ["a", "b"]


SECURITY = "report_period string, security_id string, prefix string, security_status string, correction_indicator string, current_upb_cents long, loan_count long, factor_e8 long, legacy_credit_score long, classic_fico long, vs4 long, involuntary_removal_upb_cents long, involuntary_removal_count long, wa_net_interest_rate_milli_pct long, wa_issuance_interest_rate_milli_pct long, wa_current_interest_rate_milli_pct long, wa_ltv_pct long, wa_cltv_pct long, wa_eltv_pct long, wa_dti_pct long, mission_density_score_centi long, mission_criteria_share_centi_pct long, green_indicator string, social_indicator string, mission_index_version string"


def test_removal_share_goldens(spark):
    base = lambda p, upb, loans, ru, rc: (p, "S", "CL", "A", "N", upb, loans, 99000000, None, None, None, ru, rc, 3000, 3000, 3000, 80, 80, 80, 40, 150, None, "Y", "", "v1")
    facts = spark.createDataFrame([base("2026-01", 29000, 2, 0, 0), base("2026-02", 28000, None, 300, 1), base("2026-03", 27000, 2, 100, 1), base("2026-04", 26000, 2, None, 1)], SECURITY)
    out = {(r.report_period, r.component): r for r in cube.security_cube(facts, "latest").where("contract_id = 'involuntary_removal_share'").collect()}
    assert out["2026-02", "involuntary_removal_upb_share"].value == pytest.approx(300 / 29000)
    assert out["2026-02", "involuntary_removal_count_share"].value == 0.5
    assert out["2026-03", "involuntary_removal_count_share"].denominator is None
    assert out["2026-04", "involuntary_removal_upb_share"].denominator is None
    labels = {r.member for r in cube.security_cube(facts, "latest", ("mission_metrics",)).collect()}
    assert labels == {"1.50", "Missing", "v1"}


def test_rolling_and_change_need_whole_months(spark):
    months = [f"2024-{m:02d}" for m in (1, 2, 3, 5, 6, 7)]
    facts = spark.createDataFrame([(p, 100 * (i + 1)) for i, p in enumerate(months)], "report_period string, issuance_cents long")
    rows = {(r.report_period, r.component): r for r in cube.issuance(facts, F.lit("g")).collect()}
    assert int(rows["2024-03", "rolling_3_upb"].numerator) == 600 and ("2024-05", "rolling_3_upb") not in rows and int(rows["2024-07", "rolling_3_upb"].numerator) == 1500
    assert rows["2024-02", "issuance_upb_mom"].value == 1.0 and ("2024-05", "issuance_upb_mom") not in rows


HEADER = ["Prefix", "Security Identifier", "Issuance Investor Security UPB", "Current Investor Security UPB", "Security Factor", "Security Status Indicator", "Security Data Correction Indicator"]


def archive(path, rows, header=HEADER, members=1):
    with zipfile.ZipFile(path, "w") as z:
        for i in range(members):
            z.writestr(f"m{i}.txt", "﻿" + "\n".join(["|".join(header), *("|".join(r) for r in rows)]))


def contract():
    versions = [{"version": "v1", "header_sha256": contracts.header_sha256(HEADER), "column_count": 7, "period_min": "2024-01", "period_max": "2024-12"}]
    out = {"families": [{"id": "issuance", "pattern": r"^IS_(?P<year>20\d{2})(?P<month>0[1-9]|1[0-2])\.zip$", "schema_versions": versions}]}
    contracts.validate(out)
    return out


def test_issuance_archives(spark, tmp_path):
    good = tmp_path / "good"
    good.mkdir()
    archive(good / "IS_202401.zip", [["CL", "A1", "100", "50", "0.5", "A", "N"], ["QQ", "A2", "300", "300", "1", "A", "Y"], ["CL", "A3", "", "", "", "C", ""]])
    archive(good / "IS_202402.zip", [["CL", "A1", "10", "5", "0.5", "A", "N"]])
    batch = issuance.load(spark, str(good), contract())
    out = issuance.payload(batch, {"CL": "30-year"}, "Other")
    assert [(m["month"], m["security_count"], m["issuance_upb"], m["revision_count"]) for m in out["months"]] == [("2024-01", 2, 400.0, 1), ("2024-02", 1, 10.0, 0)]
    assert [(m["month"], m["product_group"], m["issuance_share"]) for m in out["mix"]] == [("2024-01", "Other", 0.75), ("2024-01", "30-year", 0.25), ("2024-02", "30-year", 1.0)]
    assert batch.issues.where("severity = 'info'").count() == 1
    assert {k: out["metadata"]["mix"][k] for k in ("mapped_observation_count", "unmapped_observation_count", "mapped_issuance_upb", "unmapped_issuance_upb")} == {"mapped_observation_count": 2, "unmapped_observation_count": 1, "mapped_issuance_upb": 110.0, "unmapped_issuance_upb": 300.0}
    # The cache reads what is new, and nothing else.
    cache = str(tmp_path / "cache")
    first = sorted(map(str, archives.inventory_cached(spark, str(good), contract(), cache).collect()))
    archive(good / "IS_202403.zip", [["CL", "A1", "10", "5", "0.5", "A", "N"]])
    again = archives.inventory_cached(spark, str(good), contract(), cache)
    assert len(first) == 2 and again.count() == 3 and parts.Parts(spark, cache).read().count() == 3
    assert sorted(map(str, again.where("file != 'IS_202403.zip'").collect())) == first
    row = again.where("file = 'IS_202401.zip'").first()
    data = (good / "IS_202401.zip").read_bytes()
    assert (row.sha256, row.size, row.member_sha256) == (hashlib.sha256(data).hexdigest(), len(data), hashlib.sha256(zipfile.ZipFile(good / "IS_202401.zip").read(row.member)).hexdigest())
    # Touched, but the same bytes: hashed, not inflated; gone: out of the cache.
    os.utime(good / "IS_202401.zip", (1, 1))
    inflated, plain = [], archives.zip_stream
    archives.zip_stream = lambda spark, *paths, **k: inflated.extend(paths) or plain(spark, *paths, **k)
    try:
        assert sorted(map(str, archives.inventory_cached(spark, str(good), contract(), cache).where("file != 'IS_202403.zip'").collect())) == first and not inflated
        archive(good / "IS_202402.zip", [["CL", "A1", "11", "5", "0.5", "A", "N"]])
        assert archives.inventory_cached(spark, str(good), contract(), cache).count() == 3 and [p.rsplit("/", 1)[-1] for p in inflated] == ["IS_202402.zip"]
    finally:
        archives.zip_stream = plain
    (good / "IS_202403.zip").rename(tmp_path / "IS_202403.zip")
    assert archives.inventory_cached(spark, str(good), contract(), cache).count() == 2
    (tmp_path / "IS_202403.zip").rename(good / "IS_202403.zip")
    again = archives.inventory_cached(spark, str(good), contract(), cache)
    with pytest.raises(archives.NotReady, match="2024-04"):
        archives.require_ready(archives.readiness(again, contract()))


SAMPLE = "report_month,security_id,security_type,issuance_upb,current_upb,factor,cpr_pct,published_files,expected_files,release_lag_days,revision_flag"


def test_delimited_sources(spark, tmp_path):
    row = lambda m, i, **k: ",".join(str(k.get(n, v)) for n, v in zip(SAMPLE.split(","), (m, i, "UMBS", 184000000, 179420000, 0.9751, 6.4, 12, 12, 1, "false")))
    (tmp_path / "monthly.csv").write_text("\ufeff" + "\n".join([SAMPLE, row("2026-01", "SD1001"), row("2026-02", '"SD,1002"'), row("2026-02", "SD1003", published_files=11)]) + "\r\n")
    (tmp_path / "piped.txt").write_text("\n".join([SAMPLE.replace(",", "|"), row("2026-03", "SD1001").replace(",", "|")]))
    (tmp_path / "bad.csv").write_text("\n".join([SAMPLE, row("2026-03", "SD2", factor="x"), row("2026-3", "SD3"), row("2026-03", "SD4", revision_flag="maybe"), row("2026-03", "SD1001")]))
    (tmp_path / "short.csv").write_text("report_month,factor\n2026-01,1\n")
    (tmp_path / "empty.csv").write_text(SAMPLE + "\n")
    batch = issuance.load(spark, str(tmp_path), contract(), str(tmp_path.parent / f"{tmp_path.name}-work"))
    m = {r.source_file: r for r in batch.manifest.collect()}
    assert (m["monthly.csv"].report_period, m["monthly.csv"].accepted_count, m["monthly.csv"].quality_status) == ("2026-01..2026-02", 3, "pass") and m["piped.txt"].report_period == "2026-03"
    # Files in order of their names: the first to have a key keeps it.
    assert (m["bad.csv"].rejected_count, m["bad.csv"].accepted_count, m["piped.txt"].duplicate_count) == (3, 1, 1)
    assert {r.source_file: r.message for r in batch.issues.where("source_row is null").collect()} == {"short.csv": "INVALID_SOURCE: missing required columns: " + ", ".join(sorted(set(SAMPLE.split(",")) - {"report_month", "factor"})), "empty.csv": "INVALID_SOURCE: source contains no data rows"}
    assert {(r.security_id, r.source_row) for r in batch.facts.where("source_file = 'monthly.csv'").collect()} == {("SD1001", 2), ("SD,1002", 3), ("SD1003", 4)}


def test_large_files_are_read_by_many_tasks(spark, tmp_path):
    """Lines are numbered where they are read; each number is the line's own, whatever the splits."""
    (tmp_path / "large.csv").write_text("".join(f"line {i},{'x' * (i % 97)}\n" for i in range(1, 20_001)))
    (tmp_path / "small.csv").write_text("line 1,\r\nline 2,")
    for size in ("16k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            lines = archives.text_lines(spark, str(tmp_path), "*.csv")
            tasks = lines.where("file = 'large.csv'").select(F.spark_partition_id().alias("p")).distinct().count()
            assert lines.where("value not like concat('line ', line, ',%')").count() == 0 and lines.count() == 20_002
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert size == "128m" or tasks > 1


def test_wide_files_keep_all_cells(spark, tmp_path):
    """Columns that a header may have beyond those that are read, in any number and place."""
    extra = [f"extra{i}" for i in range(90)]
    row = ["2026-01", "SD1", "UMBS", "184000000", "179420000", "0.9751", "6.4", "12", "12", "1", "false"]
    (tmp_path / "wide.csv").write_text(",".join([*extra, SAMPLE]) + "\n" + ",".join(['"a,b"'] * 90 + row) + "\n")
    batch = issuance.load(spark, str(tmp_path), contract())
    assert [(r.security_id, r.cpr_pct) for r in batch.facts.collect()] == [("SD1", 6.4)]


def test_archive_digests(spark, tmp_path):
    archive(tmp_path / "IS_202401.zip", [["CL", "A1", "100", "50", "0.5", "A", "N"], ["QQ", "\u00e9", "", "", "", "", ""]])
    archive(tmp_path / "IS_202403.zip", [], members=2)
    (tmp_path / "other.zip").write_bytes(b"not a zip")
    stream = archives.stored(archives.zip_stream(spark, str(tmp_path)), str(tmp_path / "kept"))
    assert sorted(map(str, archives.lines_of(stream).collect())) == sorted(map(str, archives.zip_lines(spark, str(tmp_path)).collect()))
    found = {r.file: r for r in archives.digests_of(stream).collect()}
    data, member = (tmp_path / "IS_202401.zip").read_bytes(), zipfile.ZipFile(tmp_path / "IS_202401.zip")
    text = member.read(member.namelist()[0])
    keys = hashlib.blake2b("".join("|".join(x.split("|")[:3]) + "\n" for x in text.decode("utf-8-sig").splitlines()).encode(), digest_size=32).hexdigest()
    own = found["IS_202401.zip"]
    assert (own.sha256, own.size, own.member_sha256, own.member_size, own.keys_blake2b, own.lines, own.error) == (hashlib.sha256(data).hexdigest(), len(data), hashlib.sha256(text).hexdigest(), len(text), keys, 3, None)
    assert found["other.zip"].sha256 == hashlib.sha256(b"not a zip").hexdigest() and found["other.zip"].member_sha256 is None and "BadZipFile" in found["other.zip"].error


def test_bad_archives_block(spark, tmp_path):
    archive(tmp_path / "IS_202401.zip", [["CL", "A1", "100", "50", "0.5", "A", "N"], ["CL", "A1", "100", "50", "0.5", "A", "N"], ["CL", "A2", "x", "50", "0.5", "A", "N"], ["CL", "A4", "1"]])
    archive(tmp_path / "IS_202402.zip", [["CL"]], ["Prefix"])
    archive(tmp_path / "IS_202403.zip", [], members=2)
    archive(tmp_path / "IS_202501.zip", [["CL", "A1", "100", "50", "0.5", "A", "N"]])
    (tmp_path / "other.zip").write_bytes(b"not a zip")
    batch = issuance.load(spark, str(tmp_path), contract())
    m = {r.source_file: r for r in batch.manifest.collect()}
    assert len(m) == 5 and all(r.quality_status == "fail" for r in m.values())
    assert (m["IS_202401.zip"].accepted_count, m["IS_202401.zip"].duplicate_count, m["IS_202401.zip"].rejected_count) == (1, 1, 2)
    with pytest.raises(issuance.ReleaseBlocked):
        issuance.payload(batch, {}, "Other")
    files = archives.inventory(archives.zip_lines(spark, str(tmp_path)), contract())
    assert {r.file: r.blocker for r in files.collect()}["IS_202501.zip"] == "no single schema version fits"
    assert archives.readiness(files, contract()).where("received > 0").count() == 1


def test_contracts_are_checked():
    for bad in ({"families": []}, {"families": [{"id": "a", "pattern": "x", "schema_versions": [{}]}]}, {"families": [{"id": "a", "pattern": r"(?P<year>\d)(?P<month>\d)", "schema_versions": []}]}):
        with pytest.raises(contracts.ContractError):
            contracts.validate(bad)
    assert contracts.denied_keys({"a": [{"SSN": 1}]}, frozenset({"ssn"})) == ["$.a[0].SSN"]


def test_release_moves_only_when_sound(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = spark.range(5)
    release.publish(spark, root, "r1", {"metrics": df}, lambda t: {"none": t["metrics"].where("id < 0")})
    assert release.current(spark, root)["release"] == "r1" and release.read(spark, root, "metrics").count() == 5
    with pytest.raises(release.CheckFailed):
        release.publish(spark, root, "r2", {"metrics": df}, lambda t: {"any": t["metrics"]})
    assert release.current(spark, root)["release"] == "r1"
    with pytest.raises(AnalysisException):  # a name is used once
        release.publish(spark, root, "r1", {"metrics": df.limit(0)}, lambda t: {})
    assert release.read(spark, root, "metrics").count() == 5
    release.publish(spark, root, "r3", {"metrics": spark.range(7)}, lambda t: {})
    assert release.current(spark, root)["release"] == "r3" and release.read(spark, root, "metrics").count() == 7
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("current.json.")]


def test_incremental_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    release.replace_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "source_file string, n int"), path)
    release.replace_partitions(spark.createDataFrame([("b", 3)], "source_file string, n int"), path)
    assert sorted((r.source_file, r.n) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]
    manifest = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "source_file string, checksum string, rows int")
    built = spark.createDataFrame([("a", "x", 1, "f1"), ("b", "y", 2, "f0")], "source_file string, checksum string, rows int, fingerprint string")
    assert [r.source_file for r in release.stale(manifest, built, "f1").collect()] == ["b"]


def test_windows_in_a_stream(spark, tmp_path):
    from ledgerline.streaming import events

    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    q = events.windowed(stream, "1 day", "1 hour").writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    batch = rows.groupBy(F.window("ts", "1 day").alias("w"), "event_type").count()
    assert spark.table("w").agg(F.sum("n")).first()[0] == rows.count() and spark.table("w").count() == batch.count()


def test_whole_build_verifies(spark, tmp_path):
    """Every check of a whole build: none finds anything."""
    from ledgerline import queries
    from ledgerline.plans import bindings, engine

    sf = "/root/testdata/sf0.001"
    loans, views, manifests = bindings.loans(spark, sf), queries.views(spark, sf), queries.manifests(spark, sf)
    joins = population.join_counts(queries.joined(spark, sf))
    built = engine.build_metrics(views, loans, bindings.securities(spark, sf), bindings.product_group(), manifests, joins.groupBy("join_reason").agg(F.sum("row_count").alias("row_count")), queries.completeness(spark, sf), queries.issued(spark, sf), keep=lambda f: archives.stored(f, str(tmp_path / "kept")))
    built = archives.stored(built.coalesce(4), str(tmp_path / "cube"))
    checks = engine.verify_metrics(built, loans, views, manifests, joins)
    assert len(checks) == 18 and {n for n, c in checks.items() if c.limit(1).count()} == set()
    assert built.select("contract_id").distinct().count() == 38 and engine.dashboard(built)["components"] == built.count()
    assert built.where("contract_id = 'source_population_accounting' and member = 'issuance'").count() > 0
    assert {r.dimension for r in built.where("dimension like 'score:%'").select("dimension").distinct().collect()} == {f"score:{s}" for s in ("legacy_credit_score", "classic_fico", "vs4", "updated_legacy_credit_score", "updated_classic_fico", "updated_vs4")}
