"""The pipeline on a small corpus: every stage against a plain version applied to what its predecessor kept."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import mixing, quality, tokens

from .test_near_dedup import plain_kept
from .test_operators import plain_decontam, plain_mix


def make_corpus():
    rng = np.random.default_rng(21)
    prose = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 3000, n))
    items = [(1, prose(30)), (2, prose(12)), (None, prose(15)), (3, None), (4, "")]
    texts, kinds = [], []
    for i in range(240):
        kind = ("good", "good", "good", "junk", "toxic", "leak", "copy", "near")[i % 8]
        text = prose(int(rng.integers(40, 160)))
        if kind == "junk":
            text = " ".join(f"{w}###" for w in text.split())
        elif kind == "toxic":
            text += " vile trash vile scum " * 3
        elif kind == "leak":
            text += " " + items[i % 3][1]
        elif kind in ("copy", "near"):
            text = texts[i - i % 8]
            text = text if kind == "copy" else text + " more"
        texts.append(text)
        kinds.append(kind)
    rows = [(i, t, "en" if i % 3 else None, ["a", "b", None][i % 3], len(t)) for i, t in enumerate(texts)]
    labels = [(i, int(k != "junk"), int(k == "toxic")) for i, k in enumerate(kinds) if i % 2 or k == "toxic"]
    junk, toxic = next(t for t, k in zip(texts, kinds) if k == "junk"), next(t for t, k in zip(texts, kinds) if k == "toxic")
    rows += [(None, junk, "en", "a", 1), (None, toxic, "en", "b", 2), (0, junk, "en", "a", 3), (903, toxic, "en", "a", 4), (903, prose(60), "en", "a", 5)]
    rows += [(None, texts[0], "en", "a", 5), (0, texts[0], "en", "a", 6), (900, None, "en", "a", 0), (901, "", None, None, 0), (902, prose(20_000), "en", "a", 7)]
    return rows, labels, items, kinds


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows, labels, items, kinds = make_corpus()
    folder = str(tmp_path_factory.mktemp("corpus"))
    for name, data, schema in (("documents", rows, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return folder, kinds


def test_stages(spark, corpus):
    folder, kinds = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]
    before = docs.collect()

    good = stages["quality"](spark, docs, folder)
    kept = good.collect()
    assert good.columns == docs.columns and not Counter(kept) - Counter(before)
    # Each row by itself, whatever other rows of its id or without one are.
    verdicts = quality.judged(docs, labels, "source", "lang", [F.struct(*docs.columns).alias("all")]).select("row.all", "kept").collect()
    assert len(before) == len(verdicts) and Counter(r.all for r in verdicts if r.kept) == Counter(kept)
    gone = Counter(before) - Counter(kept)
    bad = lambda t: "###" in (t or "") or "vile trash" in (t or "")
    assert all(bad(r.text) or len((r.text or "").split()) < 10 for r in gone) and sum(gone.values()) >= 50
    assert sum(bad(r.text) for r in gone.elements()) == sum(bad(r.text) for r in before) - sum(bad(r.text) for r in kept)
    assert not [r for r in kept if r.doc_id is None and bad(r.text)] and {r.doc_id for r in kept} >= {0, 903}

    good = spark.createDataFrame(kept, docs.schema)
    distinct = stages["near_dedup"](spark, good, folder).collect()
    assert sorted(((r.doc_id, r.text) for r in distinct), key=str) == plain_kept([(r.doc_id, r.text) for r in kept])

    clean = stages["decontaminate"](spark, spark.createDataFrame(distinct, docs.schema), folder).collect()
    assert Counter(clean) == Counter(r for r in distinct if not plain_decontam(r.text, items)[4])
    assert not {r.doc_id for r in clean} & {i for i, k in enumerate(kinds) if k == "leak"}

    mixed = Counter(stages["mix"](spark, spark.createDataFrame(clean, docs.schema), folder).collect())
    sizes, target = plain_mix([(r.doc_id, r.text, r.source) for r in clean])
    n = lambda r: len((r.text or "").split())
    taken = Counter()
    for r, c in mixed.items():
        assert c <= mixing.MAX_EPOCHS and r in clean
        taken[r.source] += c * n(r)
    assert all(abs(taken[s] - target[s]) <= max(n(r) for r in clean if r.source == s) for s in sizes)

    out = stages["tokens"](spark, spark.createDataFrame(list(mixed.elements()), docs.schema), folder)
    t = tokens.Tokenizer()
    assert sum(r.n_tokens for r in out.collect()) == sum(c * (len(t.bpe.encode_ordinary(r.text or "")) + 1) for r, c in mixed.items())
    # The same from end to end, whatever the partitions.
    whole = sorted((r.slot, r.sha256, r.n_tokens) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == sorted((r.slot, r.sha256, r.n_tokens) for r in out.collect())


def test_no_documents(spark, corpus, tmp_path):
    folder, _ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
