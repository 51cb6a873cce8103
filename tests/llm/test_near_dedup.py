"""The pipeline's near-dedup stage against brute-force Jaccard similarity of 5-word shingles."""

import numpy as np
import pytest

from ledgerline.llm import mixing, near_dedup, pipeline


def plain_shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_kept(rows):
    sets = [plain_shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {}
    for (i, t), x in zip(rows, label):
        if x not in least or (i is None, i or 0) < (least[x][0] is None, least[x][0] or 0):
            least[x] = (i, t)
    return sorted(least.values(), key=str)


def make_rows():
    rng = np.random.default_rng(11)
    rows = [(1, None), (2, ""), (3, "one"), (4, "ONE"), (5, "one two"), (5, "one two")]
    for base in range(40):
        words = [f"w{i}" for i in rng.integers(0, 3000, 200)]
        rows.append((len(rows) + 10, " ".join(words)))
        for changes in (1, 3, 4, 5, 6, 9):  # similarity 0.95 down to 0.6
            copy = list(words)
            for at in rng.choice(200, changes, replace=False):
                copy[at] = "changed"
            rows.append((len(rows) + 10, " ".join(copy)))
    a = [f"v{i}" for i in range(100)]
    rows += [(9000, " ".join(a)), (None, " ".join(a[4:] + ["x"] * 2)), (9001, " ".join(a[10:] + ["x"] * 8))]
    b = " ".join(f"u{i}" for i in range(60))
    return rows + [(None, b), (None, b), (9100, " ".join(f"t{i}" for i in range(60)))]


@pytest.mark.parametrize("weight", [1 << 20, 300])
def test_stage_finds_all_similar_texts(spark, weight, monkeypatch):
    monkeypatch.setattr(near_dedup, "WEIGHT", weight)
    rows = make_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r.doc_id, r.text) for r in pipeline.distinct(spark, docs, "").collect()]
    assert sorted(kept, key=str) == plain_kept(rows)


def test_stage_on_an_empty_table(spark):
    assert near_dedup.keep_first(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_row_of_each_component_stays(spark):
    """Whatever ids equal rows have: shared, none, or more columns that clash with names used inside."""
    text = " ".join(f"x{i}" for i in range(30))
    rows = [(5, text, 1, "a"), (5, text, 2, "b"), (7, text, 3, "c"), (None, text, 4, "d"), (None, text, 4, "d"), (None, "other words", 5, "e"), (None, "other words", 6, "f"), (8, "", 7, "g"), (8, None, 8, "h"), (9, text + " more", 9, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name int, gone string").repartition(4)
    kept = near_dedup.keep_first(docs).collect()
    assert {(r.doc_id, r.text) for r in kept if r.text} == {(None, "other words"), (5, text)}
    assert len(kept) == 3 and kept[0].asDict().keys() == {"doc_id", "text", "name", "gone"}
    assert sorted(map(str, near_dedup.keep_first(docs.repartition(2)).collect())) == sorted(map(str, kept))


def test_copies_meet_a_key_once(spark):
    """However many copies a text has, its keys are dealt out once."""
    text = " ".join(f"c{i}" for i in range(50))
    docs = spark.createDataFrame([(i, text if i % 3 else f"{text} tail") for i in range(600)], "doc_id long, text string")
    met = []
    plain = near_dedup.candidates
    near_dedup.candidates = lambda sets: met.append(sets.count()) or plain(sets)
    try:
        assert [r.doc_id for r in near_dedup.keep_first(docs).collect()] == [0]
    finally:
        near_dedup.candidates = plain
    assert met == [2]


def test_columns_of_any_type_pass(spark):
    """Maps, and what holds them, have no hash of their own."""
    text = " ".join(f"m{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "a", {"k": 1}, [{"x": 2}]), (1, text, "a", {"k": 2}, []), (1, text, "a", {"k": 1}, [{"x": 2}]), (2, None, "b", None, None)], "doc_id long, text string, source string, tags map<string,int>, more array<map<string,int>>")
    kept = near_dedup.keep_first(docs).collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {1, 2}
    taken = mixing.take(docs)
    assert taken.columns == docs.columns and {str(r) for r in taken.collect()} <= {str(r) for r in docs.collect()}


def test_fingerprints_find_candidates(spark, monkeypatch):
    """Without any shared key: fingerprints within op1's radius, and equal ones, meet; what meets is compared exactly."""
    rng = np.random.default_rng(5)
    rows = []
    for base in range(12):
        words = [f"w{i}" for i in rng.integers(0, 5000, 1500)]
        rows += [(10 * base + i, " ".join([*words[:700], *(["changed"] * i), *words[700 + i :]])) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    near = {i for i in range(12) if bin(near_dedup.simhash.majority(near_dedup.shingles(rows[2 * i][1].encode())) ^ near_dedup.simhash.majority(near_dedup.shingles(rows[2 * i + 1][1].encode()))).count("1") <= near_dedup.simhash.RADIUS}
    assert len(near) > 6
    monkeypatch.setattr(near_dedup, "candidates", lambda sets: spark.createDataFrame([], "x long, y long"))
    kept = {r.doc_id for r in near_dedup.keep_first(docs).collect()}
    assert kept == {i for i, _ in rows} - {10 * i + 1 for i in near}
    met = spark.createDataFrame([(1, "a b c d e f g h", 7), (2, "s t u v w x y z", 7)], "sid long, text string, fp long")
    assert [tuple(r) for r in near_dedup.near_prints(met.select("sid", "fp")).collect()] == [(2, 1)]
