"""Fill-in-the-middle against a plain version that slices strings."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import fim

TEXTS = ["", None, "x", "abc", "<S", "has <P> in", "<M>", "hé 한국어 😀😀 x" * 50, "é" * 3000, "a\x00b\n\r\t" * 9, "é" * 40, "word " * 900, "\U0001f468‍\U0001f469" * 700]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fim(text, h):
    text = text or ""
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [1 << 20, 64, 4])
def test_cuts_whatever_the_blocks(block, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", block)
    rng = np.random.default_rng(0)
    for texts in (TEXTS, TEXTS[:2], [None], []):
        for _ in range(3):
            h = rng.integers(0, 1 << 32, (len(texts), 4))
            array = pa.array(["off", *texts], pa.string()).slice(1)
            found = list(zip(*(c.to_pylist() for c in fim.rearranged(array, h))))
            assert found == [plain_fim(t, list(map(int, k))) for t, k in zip(texts, h)]


def test_digests(spark):
    ids = [None, *range(60), -5, 7]
    rows = [(i, TEXTS[k % len(TEXTS)]) for k, i in enumerate(ids)]
    found = fim.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = []
    for i, text in rows:
        digest = sha(f"1:{'' if i is None else i}")
        n, form, prefix, middle, output = plain_fim(text, [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)])
        want.append((i, n, form, prefix, middle, sha(output), sha(text or "")))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_transform_keeps_other_columns(spark):
    rows = [(k, "key", t, {"a": 1}, "fim") for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id int, key string, Text string, tags map<string,int>, fim string")
    out, name = fim.transform(docs, transformed=100)
    assert name == "fim_" and out.columns == [*docs.columns, "fim_"]
    found = {r.doc_id: r for r in out.collect()}
    assert all(tuple(found[k])[:5] == row for k, row in enumerate(rows))
    assert all((r.fim_.form == "plain") == (not r.Text or r.Text in ("has <P> in", "<M>")) for r in found.values())
    back = {r.doc_id: r.text for r in out.select("doc_id", fim.restore(out["fim_.output"], out["fim_.form"]).alias("text")).collect()}
    assert back == {k: t or "" for k, t in enumerate(TEXTS)}


def test_empty_table(spark):
    assert fim.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
