"""Merkle manifest against a plain version that builds every tree as lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """Root, and for each leaf its (left, right) siblings by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            first = k // 16 * 16
            paths[i].append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + 16])))
            at[i] = k // 16
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain_manifest(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda x: x[:3])
        trees[s] = plain_tree([x[2] for x in sources[s]])
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, _, leaf, row), path in zip(sources[s], trees[s][1]):
            path = path + top
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = plain_leaf((*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in path:
                node = sha(left + node + right)
            out.append((row[0], leaf, trees[s][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def make_rows(sizes):
    rows = [(i * 7 % 100_003 - 50, s, ["en", None][i % 2], i, f"Text {i} É") for s, n in sizes.items() for i in range(n)]
    return rows + [(None, "b", None, None, None), (None, "b", "", 0, ""), (3, "b", "en", 1, "Again"), (3, "b", "en", 1, "Again"), (3, "b", "en", 1, "again"), (9, "lone", "de", 5, "LONG " * 20_000)]


@pytest.mark.parametrize("levels", [3, 1])
@pytest.mark.parametrize("sizes", [{"b": 1}, {"b": 700, None: 17, "": 16, "é": 257, "Z": 2} | {f"s{k}": 1 for k in range(30)}])
def test_manifest(spark, sizes, levels, monkeypatch):
    """With blocks of 4,096 leaves, and of 16 in several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    rows = make_rows(sizes)
    docs = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", digest string").repartition(5)
    found = sorted((tuple(r) for r in merkle.digests(docs).collect()), key=str)
    assert found == plain_manifest(rows)
    assert {r[6] for r in found} >= {True} and (len(rows) < 50 or not all(r[6] for r in found))


@pytest.mark.parametrize("n", [1, 16, 17])
def test_one_source(spark, n):
    rows = [(i, None, "en", 1, "T") for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted((tuple(r) for r in merkle.digests(docs).collect()), key=str) == plain_manifest(rows)


@pytest.mark.parametrize("field,changed", [("lang", "coalesce(lang, '')"), ("text", "concat(text, ' ')"), ("n_chars", "n_chars + 1"), ("source", "concat('x', source)"), ("doc_id", "-doc_id")])
def test_proofs_show_a_change_of_any_field(spark, field, changed):
    docs = spark.createDataFrame([(i, "b", None, i, f"t{i}") for i in range(1, 40)], SCHEMA)
    found = merkle.manifest(docs, {k: F.col(k) for k in merkle.FIELDS[1:]})
    fields = {k: F.col(k) for k in merkle.FIELDS}
    assert merkle.verify(found, merkle.leaf(**fields)).where("verified").count() == 39
    assert merkle.verify(found, merkle.leaf(**fields | {field: F.expr(changed)})).where("verified").count() == 0


def test_empty_table(spark):
    assert merkle.digests(spark.createDataFrame([], SCHEMA)).count() == 0
