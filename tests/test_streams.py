"""Joins and cohorts on unbounded input, whose batches come in any order, against the batch forms."""

import random
from collections import Counter

import pytest

from ledgerline.operators import population
from ledgerline.plans import incremental, transitions
from ledgerline.streaming import cohorts, joins

LOAN = "loan_id string, security_id string, report_period string, correction_indicator string, source_file string, source_row long"
SECURITY = "security_id string, report_period string, security_status string"
END = "2199-12"  # later than all: the watermark passes everything else


def period(month):
    return f"{2020 + month // 12}-{month % 12 + 1:02d}"


def arriving(spark, folder, schema, batches, build, name, checkpoint):
    """Every row that ``build`` of the stream gives, batch after batch."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(folder)
    query = cohorts.started(build(spark.readStream.schema(schema).parquet(folder)).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", checkpoint), spark)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        query.processAllAvailable()
    found = query.lastProgress
    query.stop()
    return spark.table(name).collect(), found


def join_rows(seed):
    rng = random.Random(seed)
    loans = [(f"L{i}", rng.choice([None, *(f"S{k}" for k in range(9))]), period(rng.randrange(6)), rng.choice([None, "N", "N", "D"]), "f", i) for i in range(120)]
    securities = [(rng.choice([None, *(f"S{k}" for k in range(7))]), period(rng.randrange(8)), rng.choice(["A", "A", "A", None, "P"])) for _ in range(40)]
    return loans, securities


@pytest.mark.parametrize("seed", [1, 2])
def test_streamed_join_agrees(spark, tmp_path, seed):
    """Three shuffled batches of either input, securities before and after their loans: the reasons of the batch join."""
    loans, securities = join_rows(seed)
    want = Counter(tuple(r) for r in population.join_reason(spark.createDataFrame(loans, LOAN), spark.createDataFrame(securities, SECURITY)).collect())
    rng = random.Random(seed + 10)
    rng.shuffle(loans), rng.shuffle(securities)
    # Watermarks are those of both inputs and of each way through the plan: the last rows take all.
    last_loans = [("E1", "E", END, None, "f", -1), ("E2", None, END, "D", "f", -2)]
    last_securities = [("E", END, "A")]
    folders = {k: str(tmp_path / k) for k in ("loans", "securities")}
    for k, schema in (("loans", LOAN), ("securities", SECURITY)):
        spark.createDataFrame([], schema).coalesce(1).write.parquet(folders[k])
    streams = [spark.readStream.schema(s).parquet(folders[k]) for k, s in (("loans", LOAN), ("securities", SECURITY))]
    query = joins.join_reasons(*streams, delay="400 days", deals=2).writeStream.format("memory").queryName(f"reasons{seed}").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    for b in range(4):
        for k, schema, rows, last in (("loans", LOAN, loans, last_loans), ("securities", SECURITY, securities, last_securities)):
            spark.createDataFrame(last if b == 3 else rows[b::3], schema).coalesce(1).write.mode("append").parquet(folders[k])
        query.processAllAvailable()
    query.stop()
    found = Counter(tuple(r) for r in spark.table(f"reasons{seed}").collect() if r.report_period != END)
    assert found == want
    assert {r[-1] for r in found} == set(population.JOIN_REASONS)


def test_join_of_bounded_inputs(spark):
    """Equal rows stay as many, months that are none are left out, empty inputs give none; a late security has ``wait`` months."""
    loans, securities = join_rows(3)
    frames = spark.createDataFrame([*loans, *loans[:5], ("X", "S1", "soon", None, "f", 500), ("Y", "S1", None, "D", "f", 501)], LOAN), spark.createDataFrame(securities, SECURITY)
    want = Counter(tuple(r) for r in population.join_reason(spark.createDataFrame([*loans, *loans[:5]], LOAN), frames[1]).collect())
    assert Counter(tuple(r) for r in joins.join_reasons(*frames).collect()) == want
    assert joins.join_reasons(frames[0].limit(0), frames[1]).count() == 0
    one = spark.createDataFrame([("L", "S", "2020-01", None, "f", 1)], LOAN)
    for month, reason in (("2020-01", "matched"), ("2020-04", "late"), ("2020-05", "unmatched"), ("2019-12", "unmatched")):
        assert joins.join_reasons(one, spark.createDataFrame([("S", month, "A")], SECURITY), wait=3).first().join_reason == reason
    assert joins.join_reasons(one, frames[1].limit(0)).first().join_reason == "unmatched"


def test_join_counts_without_pairs(spark):
    """The reasons counted; loans of an id with many months are not multiplied by these before they are told."""
    loans, securities = join_rows(4)
    frames = spark.createDataFrame([*loans, *loans[:5], ("X", "S1", "soon", None, "f", 500)], LOAN), spark.createDataFrame(securities, SECURITY)
    want = {(r.report_period, r.join_reason): r.row_count for r in population.join_counts(population.join_reason(frames[0].where("report_period != 'soon'"), frames[1])).collect()}
    found = Counter()
    for r in joins.reason_counts(*frames).collect():
        found[r.report_period, r.join_reason] += r.row_count
    assert found == want
    many = spark.createDataFrame([("S", period(m), "A") for m in range(60)], SECURITY)
    told = joins._verdicts(joins._waiting(joins._timed(spark.createDataFrame([("L", "S", period(0), None, "f", i) for i in range(50)], LOAN), "62 days")), many, "62 days", 60)
    assert [(r.join_reason, r.row_count) for r in told.collect()] == [("matched", 50)]


HISTORY = "source_family string, loan_id string, security_id string, report_period string, as_of_timestamp string, publication_date string, source_file string, source_row long, join_reason string, correction_indicator string, current_upb_cents long, days_delinquent int, modification_program string"


def history(seed, loans=25, months=22):
    rng, out = random.Random(seed), []
    for k in range(loans):
        for m in range(rng.randrange(3), rng.randrange(6, months)):
            for version in range(1 if rng.random() < 0.85 else 2):
                if rng.random() < 0.97:
                    days, upb = 0 if k % 3 and m % 16 else rng.choice([0, 0, 45, 45, None if rng.random() < 0.3 else 0]), 0 if rng.random() < 0.03 else 100 + k
                    out.append(("pools", f"K{k}", None if k % 9 == 0 else "S", period(m), f"{period(m)}-0{version + 1}T00:00:00Z", "2026-01-01", "f", len(out), "matched", "N", upb, days, "MOD" if rng.random() < 0.2 else " "))
    # One whose cohort sees all of its months.
    out += [("pools", "K99", "S", period(m), "t", "p", "f", 9000 + m, "matched", "N", 7, 0 if m else 45, " ") for m in range(16)]
    return out


def batch_outcomes(spark, rows, view):
    states = transitions.history(spark.createDataFrame(rows, HISTORY), view)
    return Counter((r.loan_id, r.trigger, r.report_period, r.upb, r.status) for r in transitions.cohorts(states).collect())


def streamed_outcomes(found):
    return Counter((r.loan_id, r.kind, period(r.month - 1 - 2020 * 12), r.upb, r.status) for r in found)


LAST = ("pools", "END", "S", END, "z", "z", "f", 0, "matched", "N", 1, 0, " ")


@pytest.mark.parametrize("view", ["original", "latest"])
def test_cohorts_in_any_order(spark, tmp_path, view):
    """Batches that mix all months, then one that ends it: the batch outcomes, and no state but the last loan's."""
    rows = history(4)
    random.Random(5).shuffle(rows)
    batches = [*(rows[b::3] for b in range(3)), [LAST]]
    found, progress = arriving(spark, str(tmp_path / "in"), HISTORY, batches, lambda s: cohorts.outcomes(cohorts.states(s, view, "800 days"), view), f"any_{view}", str(tmp_path / "c"))
    want = batch_outcomes(spark, rows, view)
    assert streamed_outcomes(found) == want and {k[-1] for k in want} == {"redefault", "complete", "censored"}
    assert progress.stateOperators[0].numRowsTotal <= 3  # the month that waits, its timer


def test_cohorts_from_a_history(spark, tmp_path):
    """A stream that starts from the frontier of a batch history tells what the history left open, once."""
    rows = history(6)
    cut = period(9)
    before, after = [r for r in rows if r[3] <= cut], [r for r in rows if r[3] > cut]
    store = incremental.TransitionStore(spark, str(tmp_path / "store"))
    store.start(spark.createDataFrame(before, HISTORY))
    frontier = cohorts.frontier_states(store.frontiers.read([cut]))
    random.Random(7).shuffle(after)
    batches = [after[::2], after[1::2], [LAST]]
    found, _ = arriving(spark, str(tmp_path / "in"), HISTORY, batches, lambda s: cohorts.outcomes(cohorts.states(s, delay="800 days"), initial=frontier), "from_history", str(tmp_path / "c"))
    closed = store.sums.read().where("correction_view = 'latest' and kind != 'transition'").selectExpr("kind", "report_period", "result", "n").collect()
    total = Counter((r.kind, period(r.month - 1 - 2020 * 12), r.status) for r in found)
    for r in closed:
        total[r.kind, r.report_period, r.result] += r.n
    want = Counter()
    for (_, kind, month, _, status), n in batch_outcomes(spark, rows, "latest").items():
        want[kind, month, status] += n
    assert total == want and any(r.month - 1 - 2020 * 12 <= 9 for r in found)


def test_late_months_are_left_out(spark, tmp_path):
    """A month that comes after the watermark passed it changes nothing; timers tell outcomes without new rows of a loan."""
    of = lambda m, days, loan="A": ("pools", loan, "S", period(m), "t", "p", "f", m, "matched", "N", 5, days, " ")
    batches = [[of(0, 45), of(1, 0), of(2, 0)], [of(9, 0, "B")], [of(3, 60), of(9, 0, "C")], [LAST]]
    found, _ = arriving(spark, str(tmp_path / "in"), HISTORY, batches, lambda s: cohorts.outcomes(cohorts.states(s, delay="31 days")), "too_late", str(tmp_path / "c"))
    assert streamed_outcomes(found) == Counter({("A", "cure", period(1), 5, "censored"): 1})


def test_months_and_moments():
    assert all(cohorts.month_at(cohorts.start_of(m)) == m for m in range(1970 * 12 + 1, 2200 * 12))
