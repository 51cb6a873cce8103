"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every run of ``window`` consecutive words of a benchmark item is a pattern (an item with fewer words
is one pattern). Patterns of one length m form a table: blocks of two consecutive words give a shift,
the distance that no pattern end can lie in; where the shift is zero, the bucket of that suffix block and
the pattern's first word names the places of the benchmark text that are then compared word by word.

A broadcast holds the benchmark's words once and is bounded by their number (``MAX_WORDS``); its tables are
built once in each worker process. A larger benchmark is searched in as many passes as it takes, and an item
of more words is cut into parts that overlap by ``window`` - 1 words.

Cases: null or empty text has no words and is never hit; items without words are left out; an item whose id
is null hits words, but is not among the items listed or counted; repeated item rows count once; repeated
document rows are judged each by themselves; texts of any length are searched whole; an empty benchmark hits
nothing. Extra columns pass through ``annotate_hits`` untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, fresh, stage

WINDOW = 10
#: Benchmark words that one broadcast holds.
MAX_WORDS = 400_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Lower-cases A-Z; runs of digits, letters a-z and everything beyond ASCII."""
    return text.translate(_LOWER).split() if text else []


class WuManber:
    """Patterns of one length, each the place of its first word in the benchmark's words."""

    def __init__(self, text: list[bytes], starts: list[int], m: int):
        self.text, self.m, self.two = text, m, m >= 2
        self.far = max(1, m - 1)
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, list[int]] = defaultdict(list)
        for start in starts:
            for distance in range(self.far):
                block = self._block(text, start + m - 1 - distance)
                if self.shift.get(block, self.far) > distance:
                    self.shift[block] = distance
            self.buckets[self._bucket(text, start)].append(start)
        self.buckets.default_factory = None

    def _block(self, ws: list[bytes], end: int) -> bytes:
        return ws[end - 1] + b" " + ws[end] if self.two else ws[end]

    def _bucket(self, ws: list[bytes], start: int) -> bytes:
        return ws[start] + b" " + self._block(ws, start + self.m - 1)

    def find(self, ws: list[bytes]):
        """(start, places of equal patterns) of each occurrence, overlaps included."""
        m, far, shift, two, buckets, text = self.m, self.far, self.shift.get, self.two, self.buckets.get, self.text
        i, n = m - 1, len(ws)
        while i < n:
            step = shift(ws[i - 1] + b" " + ws[i] if two else ws[i], far)
            if step:
                i += step
                continue
            start = i - m + 1
            window = ws[start : i + 1]
            equal = [p for p in buckets(self._bucket(ws, start), ()) if text[p : p + m] == window]
            if equal:
                yield start, equal
            i += 1


class Benchmark:
    """The words of all items in one list, and a table for each pattern length; ``items`` are (id or None, words)."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.text: list[bytes] = []
        self.owner: list = []
        same: dict[bytes, bytes] = {}
        by_length: dict[int, list[int]] = defaultdict(list)
        for item, ws in items:
            m = min(window, len(ws))
            if m:
                by_length[m] += range(len(self.text), len(self.text) + len(ws) - m + 1)
                self.text += [same.setdefault(w, w) for w in ws]
                self.owner += [item] * len(ws)
        self.tables = [WuManber(self.text, starts, m) for m, starts in sorted(by_length.items())]

    def search(self, text: bytes | None) -> tuple[int, list[int], set[str]]:
        """Number of words, flat sorted [start, end) intervals of hit words, ids of items found."""
        ws = words(text)
        marks, found = [], set()
        for table in self.tables:
            for start, places in table.find(ws):
                marks.append((start, start + table.m))
                found.update(self.owner[p] for p in places)
        found.discard(None)
        return len(ws), _merged(marks), found


def _merged(marks: list[tuple[int, int]]) -> list[int]:
    flat: list[int] = []
    for a, b in sorted(marks):
        if flat and a <= flat[-1]:
            flat[-1] = max(flat[-1], b)
        else:
            flat += [a, b]
    return flat


HIT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("intervals", T.ArrayType(T.IntegerType()))])
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("intervals", pa.list_(pa.int32()))])


def parts(items: DataFrame, window: int, max_words: int) -> DataFrame:
    """item, ws (words, at most ``max_words``): items of more words in parts that share ``window`` - 1 words, so each window is in one."""

    def run(batches):
        for batch in batches:
            ids, out = [], []
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                ws = words(text)
                for i in range(0, max(1, len(ws) - window + 1), max(1, max_words - window + 1)):
                    ids.append(item)
                    out.append(ws[i : i + max(window, max_words)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.list_(pa.binary()))], ["item", "ws"])

    texts = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null")
    return texts.mapInArrow(run, "item string, ws array<binary>").where("size(ws) > 0")


#: The tables last used in this worker process, by the broadcast's name.
_BUILT: dict[str, Benchmark] = {}


def _built(name: str, shared, window: int) -> Benchmark:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Benchmark(shared.value, window)
    return _BUILT[name]


def annotate_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of n_words, n_hit, items (sorted strings), intervals; and that column's name.

    The benchmark's words are counted first. Up to ``max_words`` go to the executors at once; beyond that,
    ranges of its parts are searched one after the other, each pass adding to the last."""
    spark = docs.sparkSession
    cut = stage(parts(benchmark, window, max_words), "decontam-items")
    total = cut.agg(F.sum(F.size("ws"))).first()[0] or 0
    # Shards by hash hold half the bound on average, so that chance leaves none above it by much.
    shards = 1 if total <= max_words else -(-2 * total // max_words)
    name = fresh(docs, "hit")
    out = docs
    for k in range(shards):
        part = cut if shards == 1 else cut.where(F.pmod(F.xxhash64("item", "ws"), F.lit(shards)) == k)
        shared = spark.sparkContext.broadcast([(r.item, [bytes(w) for w in r.ws]) for r in part.collect()])
        out = _pass(out, shared, window, name, name if k else None)
        if k + 1 < shards:
            out = stage(out, "decontam")
    return out, name


def _pass(docs: DataFrame, shared, window: int, name: str, earlier: str | None) -> DataFrame:
    key = uuid.uuid4().hex

    def make():
        tables = _built(key, shared, window)

        def run(texts: list) -> list[pa.Array]:
            rows = []
            for text in texts:
                n, flat, found = tables.search(text)
                rows.append({"n_words": n, "n_hit": sum(flat[1::2]) - sum(flat[::2]), "items": sorted(found), "intervals": flat})
            return [pa.array(rows, _ARROW)]

        return run

    target = fresh(docs, "found") if earlier else name
    out = annotate(docs, "text", make, T.StructType([T.StructField(target, HIT)]))
    if not earlier:
        return out
    a, b = F.col(earlier), F.col(target)
    pairs = F.array_sort(F.concat(_pairs(a["intervals"]), _pairs(b["intervals"])))
    merged = F.aggregate(
        pairs,
        F.array().cast("array<int>"),
        lambda acc, p: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) >= p["a"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.greatest(F.try_element_at(acc, F.lit(-1)), p["b"])))).otherwise(F.concat(acc, F.array(p["a"], p["b"]))),
    )
    both = F.struct(
        a["n_words"].alias("n_words"),
        F.aggregate(F.sequence(F.lit(0), F.size(merged) - 1), F.lit(0).cast("long"), lambda acc, i: acc + F.when(i % 2 == 1, F.get(merged, i)).otherwise(-F.get(merged, i))).alias("n_hit"),
        F.array_sort(F.array_union(a["items"], b["items"])).alias("items"),
        merged.alias("intervals"),
    )
    n_hit = F.when(F.size(merged) > 0, both["n_hit"]).otherwise(F.lit(0).cast("long"))
    return out.withColumn(earlier, both.withField("n_hit", n_hit)).drop(target)


def _pairs(flat):
    return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.size(flat) - 1, F.lit(0))), lambda i: (i % 2 == 0) & (F.size(flat) > 0)), lambda i: F.struct(F.get(flat, i).alias("a"), F.get(flat, i + 1).alias("b")))


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    out, hit = annotate_hits(docs.select("doc_id", "text"), benchmark)
    h = F.col(hit)
    return out.select(
        "doc_id", h["n_words"].alias("n_words"), h["n_hit"].alias("n_hit"), F.size(h["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", h["items"]), 256).alias("items_sha256"), (h["n_hit"] > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents of which no word is hit, with all their columns."""
    out, hit = annotate_hits(docs, benchmark)
    return out.where(F.col(hit)["n_hit"] == 0).drop(hit)


#: The patterns are those of the query's contract.
DIGEST_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)
), occ AS (SELECT doc_id, item_id, i, dw.m AS m FROM dw JOIN bw ON dw.g = bw.g AND dw.m = bw.m),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
