"""The leak scan: all tokens, by containment, from five characters on."""

import re
import time

import pytest

from ledgerline.operators import leaks

from .test_queries import database, test_same_as_sql as same_as_sql  # noqa: F401


def test_tokens_are_found_inside_text(spark):
    tokens = ["12345", "1234", "ab-cd.e", "secret99", "éèéèé", None, "tail5"]
    files = {"run": "xx12345yy", "short": "1234", "other": "see ab-cd.e!", "both": "secret9912345", "wide": "éèéèé", "end": "a tail5", "twice": "tail5 tail5", "none": None, "empty": ""}
    found = leaks.leaked(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame(list(files.items()), "path string, value string"))
    expected = sorted((p, t) for p, v in files.items() for t in tokens if v and t and len(t) >= 5 and t in v)
    assert sorted(tuple(r) for r in found.collect()) == expected and len(expected) == 7


@pytest.mark.parametrize("shard", [2, 7, 1000])
def test_shards_of_tokens_find_the_same(spark, shard):
    tokens = [f"tok{i:03d}x" for i in range(40)]
    files = [("a", "tok001x tok039xtok002x"), ("a", "tok001x"), ("b", "tok0019x"), ("c", None)]
    found = leaks.leaked(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame(files, "path string, value string"), shard)
    assert sorted(tuple(r) for r in found.collect()) == [("a", "tok001x"), ("a", "tok002x"), ("a", "tok039x")]


def test_a_long_value_is_read_once(spark):
    """Linear in the text: 5 MB of it and 50,000 tokens of many lengths."""
    tokens = [(("k" * (i % 40)) + f"#{i:06d}",) for i in range(50_000)]
    value = "kkkk " * 1_000_000 + tokens[777][0]
    began = time.time()
    found = leaks.leaked(spark.createDataFrame(tokens, "token string").repartition(4), spark.createDataFrame([("p", value)], "path string, value string"))
    assert [r.token for r in found.collect()] == [tokens[777][0]] and time.time() - began < 60


def test_tokens_are_sampled_from_first_lines(spark):
    lines = [("a.zip", "m", 1, "Loan Identifier|State|CUSIP")] + [("a.zip", "m", n, f"loan-{n}|NY|{'cu' if n % 2 else f' cusip{n} '}") for n in range(2, 60)] + [("b.zip", "m", 1, "State"), ("b.zip", "m", 2, "California")]
    found = leaks.sampled_tokens(spark.createDataFrame(lines, "file string, member string, line long, value string").repartition(3))
    want = {("a.zip", f"loan-{n}") for n in range(2, 27)} | {("a.zip", f"cusip{n}") for n in range(2, 27, 2)}
    assert {(r.file, r.token) for r in found.collect()} == want


@pytest.mark.parametrize("name", ["leak_scan", "leak_sample"])
def test_leak_scans_same_as_sql(spark, database, name):  # noqa: F811
    same_as_sql(spark, database, name)


def test_all_customers_are_sought(spark):
    from ledgerline import queries

    sf = "/root/testdata/sf0.001"
    digits = lambda df, c: [re.sub(r"\D", "", r[0]) for r in df.select(c).collect()]
    tokens = {t for t in digits(spark.read.parquet(f"{sf}/customer.parquet"), "c_name") if len(t) >= 5}
    names = {f"file-{r.s_suppkey}": r.s_name.replace("#", " ") for r in spark.read.parquet(f"{sf}/supplier.parquet").collect()}
    found = {(r.path, r.token) for r in queries.queries()["leak_scan"](spark, sf).collect()}
    assert found == {(p, t) for p, n in names.items() for t in tokens if t in n} and found
