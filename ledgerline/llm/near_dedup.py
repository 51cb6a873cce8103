"""Near-duplicates by exact Jaccard similarity of 5-word shingles, 0.8 and more; the pipeline's stage.

A text's shingle hashes make a set. Candidates come from two sides. The set's 64-bit SimHash fingerprints are compared
bit-sliced as op1's are (``simhash.links``): all pairs within its radius are candidates. Fingerprints of pairs at
similarity 0.8 differ in 9.7 bits on average, beyond any radius that blocks of bits can serve; for these, 252 minima
over the set make 42 keys of six, and texts that share a key are candidates, too: at similarity 0.8 a pair shares
none with probability (1 - 0.8**6)**42, 3 in a million, and less above. Each key links its texts to the least of
them; the components of all links only say which sets must meet. There the sets are compared exactly, by counting shared shingles over an inverted index; components of
more than ``WEIGHT`` shingles are dealt into chunks, and pairs of chunks are compared in tasks of their own.
Each task returns a spanning forest of the links it finds.

Cases: texts of fewer than five words are one shingle; null, empty and blank texts have the empty set and are
linked with each other; equal sets are linked before anything is compared; very long texts are shingled whole;
rows with null doc_id link others and never name a component, and ``near_duplicates`` returns every row; an empty
table gives an empty result. ``keep_first`` keeps one row of each component: that of the least doc_id (null ids
last), of its least text hash if rows share the id, and of equal rows any one; extra columns pass through
untouched, whatever their names and types (they break ties by their hash).
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .common import annotate, fresh, hashable, small, spread_join, stage
from .simhash import components, merge

SHINGLE = 5
#: Similarity as a fraction, compared in whole numbers.
AT_LEAST = (4, 5)
BANDS, ROWS = 42, 6
SEED = 42
WEIGHT = 1 << 20

_RNG = np.random.default_rng(SEED)
_TIMES = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_FOLD = _RNG.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RNG.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def shingles(text: bytes | None) -> np.ndarray:
    """The set of shingle hashes, sorted."""
    import xxhash

    ws = text.lower().split() if text else []
    if not ws:
        return np.zeros(0, np.uint64)
    joined = b" ".join(ws)
    k = min(SHINGLE, len(ws))
    ends = list(accumulate(map(len, ws), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :])), np.uint64, len(ws) - k + 1))


def keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band; none for the empty set."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(high), 256):
        np.minimum(least, (high[i : i + 256, None] * _TIMES + _PLUS).min(axis=0), out=least)
    return (least.astype(np.uint64).reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64) + _BAND


def set_id(hashes: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def _longs(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def _make_keys():
    def run(texts):
        sets = [shingles(t) for t in texts]
        bands = [keys(s) for s in sets]
        flat = np.concatenate([*bands, np.zeros(0, np.uint64)])
        at = np.r_[0, np.cumsum([len(b) for b in bands], dtype=np.int64)].astype(np.int32)
        return [_longs([set_id(s) for s in sets]), _longs([simhash.majority(s) for s in sets]), pa.ListArray.from_arrays(pa.array(at), _longs(flat))]

    return run


def _make_sets():
    def run(texts):
        sets = [shingles(t) for t in texts]
        return [_longs([set_id(s) for s in sets]), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]

    return run


_KEYS = T.StructType([T.StructField("sid", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])
_SETS = T.StructType([T.StructField("sid", T.LongType()), T.StructField("n", T.LongType()), T.StructField("hashes", T.BinaryType())])


def candidates(sets: DataFrame) -> DataFrame:
    """Links (x, y) of each set to the least set of each of its keys. ``sets``: sid, keys; one row for each set, so that
    copies of a text, however many, meet no key more than once."""
    rows = sets.select(F.explode("keys").alias("key"), "sid").repartition("key").sortWithinPartitions("key", "sid")

    def run(batches):
        key, first = None, None
        for batch in batches:
            k, s = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(k):
                continue
            new = np.r_[k[0] != key, k[1:] != k[:-1]]
            at = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
            least = np.where(at < 0, s[0] if first is None else first, s[at])
            key, first = k[-1], least[-1]
            linked = s != least
            yield pa.RecordBatch.from_arrays([pa.array(s[linked]), pa.array(least[linked])], ["x", "y"])

    return rows.mapInArrow(run, "x long, y long").distinct()


def near_prints(sets: DataFrame) -> DataFrame:
    """Links (x, y) that join all sets whose fingerprints lie within op1's radius. ``sets``: sid, fp; a row for each set."""
    named = stage(sets.groupBy("fp").agg(F.min("sid").alias("least")), "near-prints")
    equal = spread_join(sets, named, "fp").where("sid != least").select(F.col("sid").alias("x"), F.col("least").alias("y"))
    near = stage(simhash.links(named.select("fp")), "near-within")
    end = lambda of, name: named.select(F.col("fp").alias(of), F.col("least").alias(name))
    return equal.unionByName(near.join(end("x", "a"), "x").join(end("y", "b"), "y").select(F.col("a").alias("x"), F.col("b").alias("y")))


def forest_of_sets(sets: list[np.ndarray]) -> np.ndarray:
    """Labels after joining all pairs of sets that are similar enough."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    label = np.arange(n)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    post = owner[np.argsort(token, kind="stable")]
    count = np.bincount(token)
    start, at = np.cumsum(count) - count, np.r_[0, np.cumsum(sizes)]
    for i in range(n - 1):
        mine = token[at[i] : at[i + 1]]
        mine = mine[count[mine] > 1]
        many = count[mine]
        where = np.repeat(start[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        shared = np.bincount(post[where], minlength=n)
        near = np.flatnonzero(shared[i + 1 :] * AT_LEAST[1] >= (sizes[i] + sizes - shared)[i + 1 :] * AT_LEAST[0]) + i + 1
        label = merge(label, np.full(len(near), i), near)
        if not label.any():
            break  # all joined: more links change nothing
    return label


def links(sets: DataFrame) -> DataFrame:
    """Spanning links (x, y) between similar sets of one ``root``; ``sets``: sid, n, hashes, root."""
    sums = sets.groupBy("root").agg(F.sum("n").alias("n")).where(F.col("n") > WEIGHT)
    hot = stage(sums.select("root", F.ceil(F.col("n") / WEIGHT).cast("long").alias("chunks")), "near-hot")
    n = F.coalesce("chunks", F.lit(1))
    pair = F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("other")
    rows = sets.join(small(hot), "root", "left").select("sid", "hashes", "root", F.pmod(F.xxhash64("sid"), n).alias("mine"), pair)
    rows = rows.select("root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "sid", "hashes")
    dealt = rows.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")

    def links_of(ids, sets):
        label = forest_of_sets(sets)
        ids = np.array(ids, np.int64)
        linked = np.flatnonzero(label != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]])], ["x", "y"])

    def run(batches):
        group, ids, sets = None, [], []
        for batch in batches:
            for *key, sid, hashes in zip(*(c.to_pylist() for c in batch.columns)):
                if key != group:
                    if len(ids) > 1:
                        yield links_of(ids, sets)
                    group, ids, sets = key, [], []
                ids.append(sid)
                sets.append(np.frombuffer(hashes, np.uint64))
        if len(ids) > 1:
            yield links_of(ids, sets)

    return dealt.mapInArrow(run, "x long, y long")


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of doc_id, text_key, sid; and the sets: sid, root (of its component)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", F.xxhash64("text"))
    prints = stage(annotate(docs, "text", _make_keys, _KEYS).drop("text"), "near")
    distinct = stage(prints.groupBy("sid").agg(F.min("doc_id").alias("first"), F.min("text_key").alias("any_key"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "near-distinct")
    met = components(near_prints(distinct.select("sid", "fp")).unionByName(candidates(distinct.select("sid", "keys"))))
    met = stage(met.unionByName(met.select(F.col("root").alias("x"), "root").distinct()).withColumnRenamed("x", "sid"), "near-met")
    # one text of each set is enough: that of its least doc_id, or of its least hash if none has an id
    named = stage(distinct.join(met, "sid", "left_semi").select("first", F.when(F.col("first").isNull(), F.col("any_key")).alias("any_key")), "near-named")
    by_id, by_key = small(named.where("first is not null").select(F.col("first").alias("doc_id"))), small(named.where("first is null").select(F.col("any_key").alias("text_key")).distinct())
    texts = docs.join(by_id, "doc_id", "left_semi").unionByName(docs.where("doc_id is null").join(by_key, "text_key", "left_semi").select(docs.columns))
    sets = annotate(texts, "text", _make_sets, _SETS).select("sid", "n", "hashes").groupBy("sid").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes"))
    roots = components(links(stage(sets.join(small(met), "sid"), "near-sets"))).withColumnRenamed("x", "sid")
    return prints.drop("fp", "keys"), stage(distinct.join(roots, "sid", "left").select("sid", "first", F.coalesce("root", "sid").alias("root")), "near-roots")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, component_id: the smallest doc_id reachable over similar texts, itself included."""
    prints, rooted = grouped(docs)
    least = stage(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "near-least")
    named = stage(spread_join(rooted.drop("first"), least, "root").select("sid", "component_id"), "near-components")
    return spread_join(prints, named, "sid").select("doc_id", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component of similar texts."""
    prints, rooted = grouped(docs)
    rows = stage(spread_join(prints, rooted.drop("first"), "sid").groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n")), "near-rows")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"))
    judged = spread_join(rows, first, "root").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))
    judged = judged.select(F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), F.col("text_key").alias("text")).alias("name"), "kept", "n")
    gone, again = (stage(judged.where(f).select(F.col("name").alias("gone")), "near-gone") for f in ("not kept or n > 1", "kept and n > 1"))
    name = fresh(docs, "name")
    named = docs.withColumn(name, F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64("text").alias("text")))
    others = named.join(small(gone), named[name] == gone["gone"], "left_anti").drop(name)
    # Equal in id and text: one of each, by a mergeable aggregate, so that no task gathers them.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = named.join(small(again), named[name] == again["gone"], "left_semi").groupBy(name).agg(F.min_by(F.struct(*columns), F.xxhash64(*hashable(docs, docs.columns))).alias("row"))
    return others.unionByName(one.select(*(F.col("row")[c].alias(c) for c in docs.columns)))
