"""Places of many spans in one text."""

import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import pii


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4095, 4097, 20_000])
def test_running_totals(spark, n):
    values = [random.Random(n).randrange(100) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    sums, most = df.select(pii.scan(F.col("v"), lambda a, x: a + x), pii.scan(F.col("v"), lambda a, x: F.greatest(a, x))).first()
    assert sums == [sum(values[: i + 1]) for i in range(n)][:n] if n < 5000 else sums[-1] == sum(values)
    assert most == [max(values[: i + 1]) for i in range(n)][:n] if n < 5000 else most[-1] == max(values)


def test_candidates_apart_from_base_spans(spark):
    rng = random.Random(4)
    for n in (3, 40, 300):
        at, more = 0, []
        for _ in range(n):
            at += rng.randrange(1, 9)
            more.append((at, at + rng.randrange(1, 6), "v", "l"))
            at = more[-1][1]
        base = [(0, a := rng.randrange(at), a + rng.randrange(1, 12)) for _ in range(rng.randrange(n))]
        df = spark.createDataFrame([(more, base)], "more array<struct<start:int,end:int,value:string,left:string>>, base array<struct<kind:int,start:int,end:int>>")
        found = df.select(pii.free(F.col("more"), F.col("base")).alias("f")).first().f
        assert [(c.start, c.end) for c in found] == [(a, b) for a, b, *_ in more if not any(s < b and a < e for _, s, e in base)]


def test_a_text_of_many_spans_takes_linear_time(spark):
    def took(n):
        text = " ".join(f"Mr. John Smith a{i}@b.example" for i in range(n // 2))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.time()
        row = pii.digests(df).first()
        assert row.n_email == n // 2 and row.spans.count(":") == 2 * n
        assert row.spans.split(",")[-1].split(":")[1:] == [str(text.rindex("Mr.")), str(text.rindex("Mr.") + 14)]
        return time.time() - began

    took(100)
    assert took(100_000) < 30
