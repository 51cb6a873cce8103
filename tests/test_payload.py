"""The payload's series, against SQL and on cubes with missing measures."""

import pytest

from ledgerline import queries
from ledgerline.plans import assistant, payload

from .test_queries import SF, database, test_same_as_sql as same_as_sql  # noqa: F401

EIGHT = {"loan_count", "loan_upb", "average_current_loan_balance", "30_plus_count", "60_plus_count", "90_plus_count", "modification_count_rate", "loan_correction_count"}


def test_complete_series_same_as_sql(spark, database):  # noqa: F811
    same_as_sql(spark, database, "payload_series")


def test_months_need_all_eight_measures(spark):
    rows = queries.metric(spark, SF, payload.CONTRACTS).cache()
    whole = payload.series(rows, "latest")
    assert EIGHT <= set(whole.columns) and whole.count() > 1
    month = whole.agg({"report_period": "max"}).first()[0]
    for measure in sorted(EIGHT):
        cut = payload.series(rows.where(f"not (component = '{measure}' and report_period = '{month}')"), "latest")
        assert month not in {r.report_period for r in cut.collect()}, measure


def test_two_complete_months_are_needed():
    assert len(payload.complete([{}, {}])) == 2
    with pytest.raises(ValueError):
        payload.complete([{}])


def test_rates_are_cited_as_shares():
    found = assistant.facts({"latest": [{"report_period": "2024-01", "modification_count_rate": 0.125, "security_upb": None}]})
    assert [f["text"] for f in found.values()] == ["12.50%"]


def test_concentrations_have_their_hhi(spark):
    rows = queries.metric(spark, SF, ("state_composition", "counterparty_composition", "hhi_concentration")).cache()
    month = rows.agg({"report_period": "max"}).first()[0]
    found = {r.dimension: r.hhi for r in payload.with_hhi(payload.concentration(rows), rows).collect()}
    assert set(found) == {"state", "seller", "servicer"}
    for dimension, hhi in found.items():
        members = [int(r.numerator) for r in rows.where(f"component = '{dimension}_upb' and report_period = '{month}' and dimension = '{dimension}'").collect()]
        assert members and hhi == pytest.approx(sum((m / sum(members)) ** 2 for m in members), abs=1e-9)


def test_checksums_of_large_row_numbers(spark):
    """Row numbers of a large table, whose sum is beyond a bigint, in one file's month."""
    row = 9 * 10**18
    loans = spark.createDataFrame([("2024-01", "F0", row), ("2024-01", "F0", row), ("2024-02", "F0", 1)], "report_period string, source_file string, source_row long")
    found = {r.report_period: (r.rows, r.checksum) for r in queries.source_partitions(loans).collect()}
    assert found == {"2024-01": (2, str(2 * row)), "2024-02": (1, "1")}
