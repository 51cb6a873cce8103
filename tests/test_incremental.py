"""Builds that read only what changed, gated commits and join repair, each against the whole build."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import population
from ledgerline.plans import bindings, cube, incremental, parts, release, repair, transitions

SF = "/root/testdata/sf0.001"


class Crash(Exception):
    pass


def crash_at(step):
    def after(name):
        if name == step:
            raise Crash(name)

    return after


def rows(df, columns=None):
    return Counter(tuple(r) for r in df.select(*(columns or sorted(df.columns))).collect())


# ---- parts


def make_table(spark, root, after=lambda s: None):
    table = parts.Parts(spark, root, after)
    frame = spark.createDataFrame([("a b/c", 1, "x"), ("a b/c", 2, None), ("2024-01", 3, "z")], "part string, n long, s string")
    table.commit(frame, parts.digests(frame))
    return table


@pytest.mark.parametrize("step", ["staged", "verified", "listed", "published"])
def test_a_crash_leaves_old_or_new_parts(spark, tmp_path, step):
    root = str(tmp_path / "t")
    table = make_table(spark, root)
    old = rows(table.read())
    frame = spark.createDataFrame([("a b/c", 7, "new"), ("more", 8, "new")], "part string, n long, s string")
    new = Counter({k: v for k, v in old.items() if k[1] != "a b/c"}) + rows(frame)
    with pytest.raises(Crash):
        parts.Parts(spark, root, crash_at(step)).commit(frame, parts.digests(frame))
    again = parts.Parts(spark, root)
    assert rows(again.read()) == (new if step == "published" else old)
    again.commit(frame, parts.digests(frame))
    assert rows(again.read()) == new
    assert again.vacuum() >= 1 and rows(again.read()) == new and again.vacuum() == 0


def test_commits_are_gated(spark, tmp_path):
    table = make_table(spark, str(tmp_path / "t"))
    frame = spark.createDataFrame([("p", 1, "x"), ("p", 1, "y")], "part string, n long, s string")
    for wrong in ([("p", 3, None)], [("p", 2, "17")], [("p", 2, None), ("q", 1, None)], []):
        with pytest.raises(parts.Refused):
            table.commit(frame, spark.createDataFrame(wrong, "part string, rows long, digest string"))
    assert table.version() == 1 and {r.part for r in table.listed().collect()} == {"a b/c", "2024-01"}
    swapped = spark.createDataFrame([("p", 1, "y"), ("p", 1, "x")], "part string, n long, s string")
    assert [r.digest for r in parts.digests(frame).collect()] == [r.digest for r in parts.digests(swapped).collect()]
    nulls = spark.createDataFrame([("p", 1, None), ("p", 1, "y")], "part string, n long, s string")
    assert parts.digests(nulls).first().digest != parts.digests(frame.withColumn("s", F.when(F.col("s") == "y", "y").otherwise(""))).first().digest


def test_two_commits_at_once_lose_nothing(spark, tmp_path):
    """A commit that others overtake starts again from their list."""
    root = str(tmp_path / "t")
    make_table(spark, root)
    one, two = (spark.createDataFrame([(p, 9, p)], "part string, n long, s string") for p in ("one", "two"))
    overtaken = []

    def meanwhile(step):
        if step == "listed" and not overtaken:
            overtaken.append(parts.Parts(spark, root).commit(two, parts.digests(two)))

    last = parts.Parts(spark, root, meanwhile).commit(one, parts.digests(one))
    assert (overtaken, last) == ([2], 3)
    assert {r.part for r in parts.Parts(spark, root).listed().collect()} == {"a b/c", "2024-01", "one", "two"}
    assert not release.create_once(spark, f"{root}/versions/000000000003.json", "{}")


def test_parts_are_read_alone(spark, tmp_path):
    table = make_table(spark, str(tmp_path / "t"))
    found = table.read(["2024-01"])
    assert all("2024-01" in f for f in found.inputFiles()) and [r.n for r in found.collect()] == [3]
    assert table.read([]) is None and parts.Parts(spark, str(tmp_path / "none")).read() is None


# ---- loans


@pytest.fixture(scope="module")
def loans(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("loans") / "parquet")
    bindings.loans(spark, SF).withColumn("file", F.col("source_file")).write.partitionBy("file").parquet(path)
    return path


def files_of(spark, frame):
    by = frame.groupBy("source_file").agg(F.count("*").alias("rows"), F.sum("current_upb_cents").cast("string").alias("checksum"))
    return spark.createDataFrame(by.select("source_file", "checksum", "rows").collect(), "source_file string, checksum string, rows long")


def full_cube(loans):
    base = cube.loan_base(loans)
    return cube.union([base, cube.top_n(base), cube.hhi(base), cube.threshold_rates(base), cube.modification_rate(base)])


def as_rows(c):
    return rows(c.withColumn("value", F.round("value", 9)).drop("released"))


def test_an_update_reads_changed_files_alone(spark, loans, tmp_path):
    frame = spark.read.parquet(loans)
    read = []

    def loans_of(names):
        found = spark.read.option("basePath", loans).parquet(*(f"{loans}/file={n}" for n in names))
        read.append({f.split("file=")[1].split("/")[0] for f in found.inputFiles()})
        return found.withColumn("current_upb_cents", F.col("current_upb_cents") + 5) if len(read) == 1 else found

    store = incremental.LoanStore(spark, str(tmp_path / "s"), "rules-1")
    with pytest.raises(FileNotFoundError):
        store.cube()
    manifest = files_of(spark, frame)
    before = manifest.withColumn("checksum", F.when(F.col("source_file") == "F1", "old").otherwise(F.col("checksum"))).where("source_file != 'F2'")
    assert store.update(before, loans_of) == ["F0", "F1", "F3"]
    assert store.update(before, loans_of) == [] and len(read) == 1
    assert store.update(manifest, loans_of) == ["F1", "F2"] and read[-1] == {"F1", "F2"}
    other = incremental.LoanStore(spark, str(tmp_path / "s"), "rules-2")
    assert other.stale(manifest).count() == 4
    assert other.update(manifest, loans_of) == ["F0", "F1", "F2", "F3"]
    assert as_rows(other.cube()) == as_rows(full_cube(frame))
    # A file goes, nothing else is read.
    assert other.update(manifest.where("source_file != 'F0'"), loans_of) == [] or read[-1] == {"F0", "F1", "F2", "F3"}
    assert as_rows(other.cube()) == as_rows(full_cube(frame.where("source_file != 'F0'")))


def test_short_files_stop_an_update(spark, loans, tmp_path):
    frame = spark.read.parquet(loans)
    store = incremental.LoanStore(spark, str(tmp_path / "s"), "r")
    short = files_of(spark, frame).withColumn("rows", F.col("rows") + (F.col("source_file") == "F3").cast("long"))
    with pytest.raises(release.CheckFailed, match="F3"):
        store.update(short, lambda names: frame.where(F.col("source_file").isin(names)))
    assert store.parts["totals"].version() == 0


@pytest.mark.parametrize("step,family", [("staged", 0), ("published", 0), ("verified", 1), ("published", 1)])
def test_a_broken_update_is_done_again(spark, loans, tmp_path, step, family):
    """Whatever was committed before the crash, the next update builds the same files again."""
    frame, root = spark.read.parquet(loans), str(tmp_path / "s")
    manifest, of = files_of(spark, frame), lambda names: frame.where(F.col("source_file").isin(names))
    incremental.LoanStore(spark, root, "r").update(manifest.withColumn("checksum", F.lit("old")), lambda names: of(names).withColumn("current_upb_cents", F.col("current_upb_cents") * 2))
    broken = incremental.LoanStore(spark, root, "r")
    broken.parts[list(broken.parts)[family]].after = crash_at(step)
    with pytest.raises(Crash):
        broken.update(manifest, of)
    store = incremental.LoanStore(spark, root, "r")
    assert store.update(manifest, of) == ["F0", "F1", "F2", "F3"]
    assert as_rows(store.cube()) == as_rows(full_cube(frame))


# ---- transitions


def random_loans(spark, seed, months=30):
    rng = random.Random(seed)
    out = []
    for loan in range(40):
        days, modified = 0, ""
        for m in range(months):
            if rng.random() < 0.06:
                continue
            days = rng.choice([0, 0, 0, 35, 65, 120, None]) if rng.random() < 0.35 else days
            modified = "M" if modified or rng.random() < 0.04 else ""
            for version in range(1 + (rng.random() < 0.2)):
                upb = rng.choice([100, 250, 0, None]) if rng.random() < 0.1 else 100
                out.append((rng.choice(["A", "A", "A", "B"]) if loan == 0 else "A", f"L{loan}", None if loan % 7 == 0 else f"S{loan % 3}", f"{2020 + m // 12}-{m % 12 + 1:02d}", f"t{version}", f"p{version}", "f", len(out), "matched", "N", upb, days, modified))
    schema = "source_family string, loan_id string, security_id string, report_period string, as_of_timestamp string, publication_date string, source_file string, source_row long, join_reason string, correction_indicator string, current_upb_cents long, days_delinquent long, modification_program string"
    return spark.createDataFrame(out, schema)


def happened(df):
    return rows(df, [*incremental.HAPPENED, "n", "upb"])


@pytest.mark.parametrize("seed,start", [(1, 10), (2, None), (3, 20)])
def test_months_added_one_by_one(spark, tmp_path, seed, start):
    """After each of several months, as a whole history up to there; a month without any loan between them."""
    loans = random_loans(spark, seed).where("report_period != '2021-10'").cache()
    months = sorted(r.report_period for r in loans.select("report_period").distinct().collect())
    store = incremental.TransitionStore(spark, str(tmp_path / "t"))
    at = 0
    if start is not None:
        store.start(loans.where(F.col("report_period") <= months[start]))
        at = start + 1
        assert happened(store.happened()) == happened(transitions.happenings(loans.where(F.col("report_period") <= months[start])))
    for k in range(at, min(len(months), at + 9 if start is not None else 14)):
        store.advance(loans.where(F.col("report_period") == months[k]))
        if k % 4 == 0 or k == at:
            assert happened(store.happened()) == happened(transitions.happenings(loans.where(F.col("report_period") <= months[k]))), months[k]
    # A month comes again with other rows: it replaces what it said, and so does a rewind further back.
    changed = loans.where(F.col("report_period") == months[k]).withColumn("days_delinquent", F.lit(0).cast("long"))
    store.advance(changed)
    assert happened(store.happened()) == happened(transitions.happenings(loans.where(F.col("report_period") < months[k]).unionByName(changed)))
    with pytest.raises(ValueError):
        store.advance(loans.where(F.col("report_period") == months[k - 2]))
    with pytest.raises(ValueError):
        store.advance(loans)
    loans.unpersist()


def test_only_the_frontier_is_read(spark, tmp_path):
    loans = random_loans(spark, 5, 8)
    store = incremental.TransitionStore(spark, str(tmp_path / "t"))
    store.start(loans.where("report_period <= '2020-06'"))
    read = []
    plain = store.frontiers.read
    store.frontiers.read = lambda names=None, version=None: read.append(names) or plain(names, version)
    sums = store.sums.read
    store.sums.read = lambda *a: pytest.fail("sums of earlier months are read")
    store.advance(loans.where("report_period = '2020-07'"))
    assert read == [["2020-06"]]
    store.sums.read = sums
    open_ = plain(["2020-07"])
    assert open_.where("exists(open, c -> c.month < month - 12)").count() == 0


def test_a_broken_month_is_done_again(spark, tmp_path):
    loans = random_loans(spark, 6, 8)
    root = str(tmp_path / "t")
    incremental.TransitionStore(spark, root).start(loans.where("report_period <= '2020-06'"))
    month = loans.where("report_period = '2020-07'")
    broken = incremental.TransitionStore(spark, root)
    broken.frontiers.after = crash_at("verified")
    with pytest.raises(Crash):
        broken.advance(month)
    store = incremental.TransitionStore(spark, root)
    assert happened(store.happened()) == happened(transitions.happenings(loans.where("report_period <= '2020-06'")))
    store.advance(month)
    assert happened(store.happened()) == happened(transitions.happenings(loans.where("report_period <= '2020-07'")))


# ---- join repair


def make_join(spark, seed):
    rng = random.Random(seed)
    month = lambda: f"2020-{rng.randrange(1, 7):02d}"
    loans = spark.createDataFrame([(f"L{i}", None if i % 9 == 0 else f"S{rng.randrange(30)}", month(), i, "D" if i % 17 == 0 else "N") for i in range(600)], "loan_id string, security_id string, report_period string, source_row long, correction_indicator string")
    securities = [(f"S{rng.randrange(30)}", month(), rng.choice("AAAP")) for _ in range(60)] + [(None, "2020-03", "A")]
    cut = rng.randrange(20, 40)
    schema = "security_id string, report_period string, security_status string"
    return loans, spark.createDataFrame(securities[:cut], schema), spark.createDataFrame(securities[cut:], schema)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_repair_equals_a_full_join(spark, tmp_path, seed):
    loans, before, late = make_join(spark, seed)
    store = repair.JoinedLoans(spark, str(tmp_path / "j"))
    store.publish(population.join_reason(loans, before))
    listed = {r.part: r.generation for r in store.loans.listed().collect()}
    done = store.repair(before, late)
    want = population.join_reason(loans, before.unionByName(late))
    assert rows(store.loans.read().drop("part")) == rows(want)
    assert rows(store.counts.read().drop("part")) == rows(population.join_counts(want))
    assert {r.part for r in store.loans.listed().collect() if r.generation != listed[r.part]} == set(done.months)
    old = {r.loan_id: r.join_reason for r in population.join_reason(loans, before).collect()}
    assert done.changed >= len(done.months) and sum(r.join_reason != old[r.loan_id] for r in want.collect()) >= done.changed
    assert store.repair(before.unionByName(late), late.limit(0)) == repair.Repair([], 0)


def test_a_repair_that_ended_midway(spark, tmp_path):
    """Loans are repaired, counts are not: the next run counts these months."""
    loans, before, late = make_join(spark, 4)
    root = str(tmp_path / "j")
    repair.JoinedLoans(spark, root).publish(population.join_reason(loans, before))
    broken = repair.JoinedLoans(spark, root)
    broken.counts.after = crash_at("staged")
    with pytest.raises(Crash):
        broken.repair(before, late)
    store = repair.JoinedLoans(spark, root)
    assert store.uncounted()
    store.repair(before, late)
    want = population.join_reason(loans, before.unionByName(late))
    assert not store.uncounted() and rows(store.counts.read().drop("part")) == rows(population.join_counts(want))


def test_versions_are_hashed_not_sorted(spark):
    """Histories to store: the same as by structs, with odd ranks too, and nothing is sorted before versions meet."""
    from pyspark.sql import functions as F

    from ledgerline.plans import bindings, transitions

    columns = ("loan_id", "as_of_timestamp", "publication_date", "source_file", "source_row", "current_upb_cents", "days_delinquent")
    rows = [(f"L{i % 3}", (None, "é", "z", "2020-01-01")[i % 4], (None, "b")[i // 4 % 2], ("F1", None)[i // 8 % 2], (None, -(2**63), 2**63 - 1, 0, i)[i % 5], i, None if i % 7 == 0 else i) for i in range(80)]
    loans = spark.createDataFrame(rows, "loan_id string, as_of_timestamp string, publication_date string, source_file string, source_row long, current_upb_cents long, days_delinquent long")
    loans = loans.dropDuplicates(["loan_id", *columns[1:5]]).selectExpr("*", "'pools' AS source_family", "CAST(NULL AS string) AS security_id", "'2020-01' AS report_period", "'matched' AS join_reason", "'N' AS correction_indicator", "'' AS modification_program")
    loans = spark.createDataFrame(loans.collect(), loans.schema)
    stored, plain = transitions.histories(loans, to_store=True, whole=True), transitions.histories(loans)
    assert stored.dtypes == plain.dtypes and sorted(map(str, stored.collect())) == sorted(map(str, plain.collect())) and stored.count() == 3
    plan = lambda f: f._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan(stored) and "SortAggregate" in plan(plain)
    assert "SortMergeJoin" not in plan(bindings.loans(spark, "/root/testdata/sf0.001").select(F.col("loan_id")))
    assert transitions.numbered(loans.withColumn("source_row", F.col("source_row").cast("string"))) is None
