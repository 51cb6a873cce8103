"""Copies of a document, as a mix makes them, in training order."""

import numpy as np
import pytest

from ledgerline.llm import common, mixing, tokens


def order(found):
    return [p.doc_id for r in sorted(found.collect(), key=lambda r: r.slot) for p in r.pieces if p.start == 0]


def beside(ids):
    return sum(a == b for a, b in zip(ids, ids[1:]))


@pytest.mark.parametrize("rows", [100_000, 0])
def test_epochs_lie_apart(spark, tmp_path, rows, monkeypatch):
    """400 documents three times each: neighbours are the same document as often as by chance (about twice in 1,199)."""
    monkeypatch.setattr(common, "SMALL_ROWS", rows)
    docs = spark.createDataFrame([(i, f"text {i} " * (3 + i % 5)) for i in range(400)] * 3, "doc_id long, text string").repartition(5)
    found, out = tokens.materialise(docs, f"file://{tmp_path}/a", length=16)
    ids = order(found)
    assert sorted(ids) == sorted(list(range(400)) * 3) and beside(ids) < 12
    again, other = tokens.materialise(docs.repartition(2), f"file://{tmp_path}/b", length=16)
    n = found.count()
    assert (tokens.read_slots(out, 0, n) == tokens.read_slots(other, 0, n)).all()


def test_one_document_most_of_all(spark, tmp_path):
    """Thousands of equal rows are spread over the shards, and none is lost."""
    docs = spark.createDataFrame([(7, "again and again")] * 5000 + [(i, f"other {i}") for i in range(100, 2600)], "doc_id long, text string")
    found, _ = tokens.materialise(docs, f"file://{tmp_path}/t", length=8, sequences_per_shard=500)
    rows = found.collect()
    shards = np.array([r.shard for r in rows for p in r.pieces if p.doc_id == 7 and p.start == 0])
    assert len(shards) == 5000 and len(set(shards.tolist())) > 10
    assert np.bincount(shards).max() < 1.5 * 5000 / len(set(shards.tolist()))


def test_mixed_epochs_lie_apart(spark, tmp_path):
    """From the mix to the shards: a source that is taken three times."""
    rows = [(i, f"small {i} words here", "a") for i in range(200)] + [(1000 + i, f"large {i} words here " * 9, "b") for i in range(300)]
    docs = mixing.take(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    found, _ = tokens.materialise(docs, f"file://{tmp_path}/m", length=16)
    ids = order(found)
    assert sum(i < 1000 for i in ids) == 600 and beside(ids) < 12
