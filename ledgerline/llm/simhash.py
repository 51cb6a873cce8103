"""Near-duplicates by SimHash fingerprints compared bit-sliced.

A fingerprint has 64 bits from the XXH64 values of 4-word shingles, cut into blocks of bits. Two within ``radius``
differing bits agree wholly on all but ``radius`` of the blocks, so each choice of so many blocks makes a table
of buckets, and only fingerprints of one bucket are compared. There are as many blocks as keep buckets small for
the number of fingerprints at hand (``tables``): the comparisons grow little faster than the fingerprints.
A bucket's fingerprints are kept as 64 bit planes; distances of many are counted at once by carry-save adders on
whole words, eight planes at a time, and a block of lanes is abandoned once all of them exceed the radius. Buckets
above ``CHUNK`` fingerprints are split into chunks, and pairs of chunks are compared in tasks of their own. Each
task returns a spanning forest of the links it finds, not the links; components come from alternating large-star
and small-star steps. Joins with a fingerprint or node of very many rows deal these to several tasks.

Cases: null or empty text has fingerprint zero and is linked like any other; equal texts share their
fingerprint before anything is compared; rows with null doc_id get their component and never name it;
repeated rows are returned each; very long texts are hashed whole, their bits counted in pieces; distances equal
to the radius are links; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, small, spread_join, stage

SHINGLE = 4
RADIUS = 4
SEED = 42
CHUNK = 8192
#: Fingerprints of a bucket that are expected at most, were they random.
BUCKET = 64


def fingerprint(text: bytes | None) -> int:
    import xxhash

    ws = text.lower().split() if text else []
    if not ws:
        return 0
    joined = b" ".join(ws)
    k = min(SHINGLE, len(ws))
    ends = list(accumulate(map(len, ws), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :])), np.uint64, len(ws) - k + 1))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""

    def make():
        def run(texts):
            return [pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64), pa.int64())]

        return run

    return annotate(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", make, T.StructType([T.StructField("fp", T.LongType())])).drop("text")


# ---- bit-sliced comparison


def planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes of ``values`` (uint64), each a row of words with one bit for each value."""
    lanes = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pad = -len(values) % 64
    lanes = np.vstack([lanes, np.zeros((pad, 64), np.uint8)]) if pad else lanes
    return np.ascontiguousarray(np.packbits(lanes, axis=0, bitorder="little").T).view(np.uint64)


def _add(a, b, c):
    """Carry-save adder: sum and carry of three planes."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def within(differences, shape, radius: int = RADIUS) -> np.ndarray | None:
    """Words whose bits are set where at most ``radius`` (under 8) of 64 difference planes have a one; None once no lane can."""
    one, two, four, over = (np.zeros(shape, np.uint64) for _ in range(4))
    planes_ = iter(differences)
    for _ in range(8):
        fours = []
        for _ in range(2):
            twos = []
            for _ in range(2):
                one, carry = _add(one, next(planes_), next(planes_))
                twos.append(carry)
            two, carry = _add(two, *twos)
            fours.append(carry)
        four, carry = _add(four, *fours)
        over |= carry
        alive = ~(over | _exceeds(one, two, four, radius))
        if not alive.any():
            return None
    return alive


def _exceeds(one, two, four, radius):
    """Counts 0-7 in three planes above ``radius``."""
    out = np.zeros_like(one)
    equal = ~out
    for plane, bit in ((four, radius >> 2 & 1), (two, radius >> 1 & 1), (one, radius & 1)):
        if bit:
            equal = equal & plane
        else:
            out, equal = out | (equal & plane), equal & ~plane
    return out


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index of its set) after joining a[i] with b[i]."""
    while len(a):
        ra, rb = label[a], label[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def forest_of_large(values: np.ndarray, left: int | None) -> np.ndarray:
    """Labels for one bucket: all against all, or the first ``left`` against the rest."""
    n = len(values)
    label = np.arange(n)
    queries, lanes, shift = (values, values, 0) if left is None else (values[:left], values[left:], left)
    sliced = planes(lanes)
    words, full = sliced.shape[1], np.uint64(0xFFFFFFFFFFFFFFFF)
    for q in range(0, len(queries), 64):
        block = queries[q : q + 64]
        masks = ((block[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)) * full
        for w in range(q // 64 if left is None else 0, words, 64):
            part = sliced[:, w : w + 64]
            near = within((part[b][None, :] ^ masks[:, b, None] for b in range(64)), (len(block), part.shape[1]))
            if near is None:
                continue
            bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")
            a, b = np.nonzero(bits[:, : len(lanes) - w * 64])
            label = merge(label, a + q, b + w * 64 + shift)
        if not label.any():
            break  # all joined: more links change nothing
    return label


def forest_of_small(values: np.ndarray, group: np.ndarray, largest: int) -> np.ndarray:
    """Labels for rows sorted by group, groups of at most ``largest``: lanes are pairs at distance s in the rows."""
    label = np.arange(len(values))
    for s in range(1, largest):
        at = np.flatnonzero(group[s:] == group[:-s])
        if not len(at):
            break
        for i in range(0, len(at), 1 << 16):
            lane = at[i : i + (1 << 16)]
            sliced = planes(values[lane] ^ values[lane + s])
            near = within(sliced, sliced.shape[1])
            if near is not None:
                hit = lane[np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[: len(lane)])]
                label = merge(label, hit, hit + s)
    return label


SMALL_GROUP = 24


def forest(values: np.ndarray, group: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) that join what is near within each group; ``side`` 1 and 2 are compared across only, 0 with all."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    few = np.repeat((sizes > 1) & (sizes <= SMALL_GROUP), sizes) & (side == 0)
    rows = np.flatnonzero(few)
    label = np.arange(len(values))
    if len(rows):
        label[rows] = rows[forest_of_small(values[rows], group[rows], SMALL_GROUP)]
    for start, size in zip(starts, sizes):
        part = slice(start, start + size)
        if size <= 1 or few[start]:
            continue
        s = side[part]
        if s[0] == 0:
            label[part] = start + forest_of_large(values[part], None)
            continue
        order = np.argsort(s, kind="stable")
        left = int((s == 1).sum())
        if 0 < left < size:
            label[start + order] = start + order[forest_of_large(np.ascontiguousarray(values[part][order]), left)]
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def tables(n: int, radius: int = RADIUS) -> list[list[tuple[int, int]]]:
    """For ``n`` fingerprints, the blocks (offset, width) of each table: two within the radius agree on all of one table's.

    More blocks make more tables of longer keys; the fewest are taken whose keys hold ``BUCKET`` random ones or fewer."""
    for blocks in range(radius + 2, 2 * radius + 5):
        edges = [64 * i // blocks for i in range(blocks + 1)]
        found = [[(edges[i], edges[i + 1] - edges[i]) for i in own] for own in combinations(range(blocks), blocks - radius)]
        if n >> min(sum(w for _, w in own) for own in found) <= BUCKET:
            break
    return found


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links (x, y) between the distinct fingerprints in column fp of ``prints``."""
    keys = []
    for k, own in enumerate(tables(prints.count(), radius)):
        key = F.lit(k).cast("long")
        for offset, width in own:
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned("fp", offset).bitwiseAND((1 << width) - 1))
        keys.append(key)
    rows = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = stage(rows.groupBy("key").count().where(F.col("count") > CHUNK).select("key", F.ceil(F.col("count") / CHUNK).cast("long").alias("chunks")), "simhash-hot")
    n = F.coalesce("chunks", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), n)
    pair = F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("other")
    rows = rows.join(small(hot), "key", "left").select("fp", "key", mine.alias("mine"), pair)
    rows = rows.select("fp", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"))
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")

    def run(batches):
        held: list = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            key = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
            last = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            if not len(last):
                continue
            whole = table.slice(0, int(last[-1]) + 1)
            held = table.slice(int(last[-1]) + 1).to_batches()
            yield _links_of(whole)
        if held:
            yield _links_of(pa.Table.from_batches(held))

    def _links_of(table):
        key = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
        group = np.r_[0, np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))]
        a, b = forest(table.column("fp").to_numpy().view(np.uint64), group, table.column("side").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["x", "y"])

    return dealt.mapInArrow(run, "x long, y long")


# ---- components


def components(edges: DataFrame) -> DataFrame:
    """(x, root) for each node of ``edges`` (x, y) but the roots; root is the least node of its component."""
    edges = stage(edges.where("x != y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "components")
    before, rows = None, 2 * edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = spread_join(both, least, "x", rows).where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small_star = spread_join(large, least, "x", rows).select(F.explode(F.array(F.struct(F.col("y").alias("x"), F.col("m").alias("y")), F.struct("x", F.col("m").alias("y")))).alias("e")).select("e.x", "e.y").where("x != y").distinct()
        edges = stage(small_star, "components")
        state = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before or not state[0]:
            return edges.select("x", F.col("y").alias("root"))
        before, rows = state, 2 * state[0]


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over links, itself included."""
    prints = stage(fingerprints(docs), "simhash")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(distinct, radius)).withColumnRenamed("x", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(spread_join(rooted, stage(least, "simhash-least"), "root").select("fp", "component_id"), "simhash-named")
    return spread_join(prints, named, "fp").select("doc_id", "fp", "component_id")


def digests(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
