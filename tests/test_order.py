"""Order statistics by refinement against plain sorting and SQL."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import order

from .test_queries import database, test_same_as_sql as same_as_sql  # noqa: F401


def plain(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return values[max(1, math.ceil(p * len(values))) - 1], low + (at - math.floor(at)) * (high - low)


def make(seed):
    rng = random.Random(seed)
    rows = [("ties", rng.choice([1, 2, 2, 2, 3, 900])) for _ in range(1501)] + [("same", 7)] * 400 + [("one", -3)] + [("even", rng.randrange(10**6)) for _ in range(1000)]
    rows += [("skew", int(rng.paretovariate(0.3)) % 10**15) for _ in range(999)] + [(None, rng.randrange(-50, 50)) for _ in range(333)] + [("none", None)] * 3 + [("ties", None)]
    return rows + [("wide", 2**62 + i) for i in range(700)]  # as doubles they are all one


@pytest.mark.parametrize("bins,few", [(1024, 10_000), (16, 50), (2, 1)])
def test_any_group_and_rank(spark, tmp_path, bins, few, monkeypatch):
    monkeypatch.setattr(order, "BINS", bins)
    monkeypatch.setattr(order, "FEW", few)
    rows = make(bins)
    df = spark.createDataFrame(rows, "g string, v long").repartition(4)
    wanted = {"p0": order.nearest(0.0), "d50": order.nearest(0.5), "c50": order.between(0.5), "d95": order.nearest(0.95), "p100": order.between(1.0)}
    found = {r.g: r for r in order.order_statistics(df, ["g"], "v", wanted, str(tmp_path)).collect()}
    groups = {g: [v for h, v in rows if h == g and v is not None] for g, _ in rows}
    assert set(found) == {g for g, v in groups.items() if v}
    for g, values in groups.items():
        if values:
            r = found[g]
            assert (r.p0, r.d50, r.d95) == tuple(plain(values, p)[0] for p in (0, 0.5, 0.95)), g
            assert (r.c50, r.p100) == pytest.approx(tuple(plain(values, p)[1] for p in (0.5, 1))), g


def test_doubles_and_decimals(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(order, "FEW", 20)
    rng = random.Random(3)
    values = [rng.choice([rng.gauss(0, 1e-9), rng.gauss(0, 1e9), 0.1, -0.0]) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("g", F.lit(1))
    found = order.order_statistics(df, ["g"], "v", {"m": order.between(0.5), "p": order.nearest(0.95)}, str(tmp_path)).first()
    assert found.p == plain(values, 0.95)[0] and found.m == pytest.approx(plain(values, 0.5)[1])
    exact = df.select("g", F.col("v").cast("decimal(38,6)").alias("v"))
    found = order.order_statistics(exact, ["g"], "v", {"p": order.nearest(0.3)}, str(tmp_path)).first()
    assert found.p == sorted(r.v for r in exact.collect())[math.ceil(0.3 * 2000) - 1]


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "g string, v long")
    assert order.order_statistics(df, ["g"], "v", {"m": order.between(0.5)}, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["issuance_monthly", "latency_percentiles"])
def test_queries_same_as_sql(spark, database, name):  # noqa: F811
    same_as_sql(spark, database, name)
