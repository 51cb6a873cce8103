"""Token ids in training order, as fixed-stride binary shards.

A document's tokens and an end token are cut into whole sequences of ``length`` and a rest. Part i of a document
is number h * parts + i of a domain, h a hash of its id and text and, where rows are equal in both, of the copy's number;
``parts`` is a bound on the parts of any document (a byte-level vocabulary never has more tokens than bytes). A keyed Feistel permutation with cycle-walking moves
the numbers over the domain; ranges of images go to partitions, which write shards in order of images, at a
stride of ``length`` 16-bit ids. A whole sequence is written as it comes, rests are packed one after the other
into sequences of their shard, the last of which is padded. A sequence's global slot is its rank: the sequences of
the shards before, which the index counts, plus its place. A reader resumes at any slot from index and stride.

Texts are encoded where they are read, equal ones of a batch once. Equal rows (epochs of a mix) are numbered, so that the
permutation scatters them like any others: within a task as they come, after those of earlier tasks, of which ids and
hashes alone are counted. Which of them gets which number changes nothing, as they are equal. So nothing depends on the order of rows, on input splits or on how tasks are grouped, so
retries and reruns write the same bytes.

Cases: null or empty text is its end token only; null doc_id is an id like any other; repeated rows are written
each, all over the order; different documents with one number keep the order of their hashes; very long texts are
encoded whole; without documents there is no sequence and no shard; other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Bounded, shared_dir, small, stage

VOCABULARIES = "/opt/tokenizers"
END = 50256
LENGTH = 1024
#: Sequences of one shard if every byte were a token; mostly it holds a third to a half of these.
SEQUENCES_PER_SHARD = 16384
#: Shards whose places in the order are counted together.
SHARDS_PER_GROUP = 4096
KEY = 0x5EED
ROUNDS = 6


class Tokenizer:
    """The byte-level BPE; ``encode`` gives little-endian 16-bit ids."""

    def __init__(self, path: str = VOCABULARIES):
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, (Path(path) / "byte_bpe_50k.tiktoken").read_bytes().splitlines())}
        self.bpe = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        return self.bpe.encode_to_numpy(text).astype("<u2").tobytes() if text else b""

    def decode(self, ids: bytes) -> str:
        return self.bpe.decode(np.frombuffer(ids, "<u2").tolist())


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(values: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A keyed permutation of 0..n-1: a Feistel network on the next even number of bits, walked until inside."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, h = np.uint64((1 << half) - 1), np.uint64(half)
    out = values.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> h, x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_mixed(right, (key * 0x10001 + r * 0x9E37) & 0xFFFFFFFFFFFF) & mask)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, hash) with ``earlier``: how many rows equal to one lie in tasks before its own."""
    own = F.spark_partition_id()
    counts = docs.groupBy("doc_id", "hash", own.alias("task")).count()
    upto = F.sum("count").over(Window.partitionBy("doc_id", "hash").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    later = stage(counts.withColumn("earlier", upto).where("earlier > 0").select(F.col("doc_id").alias("d"), F.col("hash").alias("h"), "task", "earlier"), "tokens-copies")
    if later.isEmpty():
        return docs.withColumn("earlier", F.lit(0).cast("long"))
    # Rows equal to others elsewhere; where these are many, texts move once more.
    met = docs.withColumn("own", own).join(small(later), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")) & (F.col("own") == F.col("task")), "left")
    return met.select("doc_id", "text", "hash", F.coalesce("earlier", F.lit(0)).cast("long").alias("earlier"))


class Shard:
    """The shard being written, under a name of its own until it is whole: a lost or doubled attempt leaves no half shard."""

    def __init__(self, store, base: str, length: int):
        self.store, self.base, self.length, self.number = store, base, length, None
        self.end = np.array([END], "<u2").tobytes()
        self.rows: list[tuple] = []

    def add(self, number: int, doc, start: int, ids: bytes) -> None:
        """One part of a document; parts shorter than a sequence are held until they fill one."""
        if number != self.number:
            self.close()
            self.number, self.place, self.name, self.held, self.pieces = number, 0, f"{self.base}/shard-{number:08d}.bin", b"", []
            self.partial = f"{self.name}.{uuid.uuid4().hex}"
            self.stream = self.store.open_output_stream(self.partial)
        if len(ids) == 2 * self.length:
            self._write(ids, [(doc, start, self.length)])
            return
        while ids:
            n = min(len(ids), 2 * self.length - len(self.held)) // 2
            self.held += ids[: 2 * n]
            self.pieces.append((doc, start, n))
            ids, start = ids[2 * n :], start + n
            if len(self.held) == 2 * self.length:
                self._flush()

    def _flush(self) -> None:
        self._write(self.held, self.pieces)
        self.held, self.pieces = b"", []

    def _write(self, body: bytes, pieces: list[tuple]) -> None:
        n = len(body) // 2
        self.stream.write(body + self.end * (self.length - n))
        self.rows.append((self.number, self.place, self.place * self.length * 2, n, [dict(zip(("doc_id", "start", "n"), p)) for p in pieces], hashlib.sha256(body).hexdigest()))
        self.place += 1

    def close(self) -> None:
        if self.number is not None:
            if self.held:
                self._flush()
            self.stream.close()
            self.store.move(self.partial, self.name)
            self.number = None

    def taken(self) -> pa.RecordBatch:
        """The index rows since the last call."""
        columns = list(zip(*self.rows)) or [[]] * 6
        self.rows = []
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "place", "byte_offset", "n_tokens", "pieces", "sha256"])


INDEX = "shard long, place long, byte_offset long, n_tokens long, pieces array<struct<doc_id:long,start:long,n:long>>, sha256 string"


def materialise(docs: DataFrame, out: str | None = None, length: int = LENGTH, sequences_per_shard: int = SEQUENCES_PER_SHARD, key: int = KEY, vocabularies: str = VOCABULARIES) -> tuple[DataFrame, str]:
    """Writes the shards below ``out`` (by default in the shared folder); returns one row per sequence, and ``out``.

    Columns: slot, shard, byte_offset, n_tokens (without padding), pieces (of which documents' tokens it consists, in
    order: doc_id, first token, number of tokens), sha256."""
    spark = docs.sparkSession
    out = out or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("hash", F.xxhash64("doc_id", "text"))
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    bound, longest = docs.agg(F.sum(F.ceil(n / length)), F.max(n)).first()
    parts = (longest or 1) // length + 1
    hashes = (1 << 62) // parts
    domain = hashes * parts
    shards = max(1, -(-(bound or 0) // sequences_per_shard))
    per_shard = -(-domain // shards)

    def deal(batches):
        tokenizer, end = Tokenizer(vocabularies), np.array([END], "<u2").tobytes()
        seen: dict[tuple, int] = {}  # an entry for each distinct row of the task
        for batch in batches:
            ids, texts, h, earlier = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text", "hash", "earlier"))
            known = Bounded(lambda t: tokenizer.encode(t) + end)
            coded = [known[t] for t in texts.to_pylist()]
            copy = np.zeros(len(coded), np.int64)
            for i, key_ in enumerate(zip(ids.to_pylist(), h.to_pylist())):
                copy[i] = seen[key_] = seen.get(key_, -1) + 1
            copy += earlier.to_numpy()
            counts = np.array([-(-len(c) // (2 * length)) for c in coded], np.int64)
            doc, first = np.repeat(np.arange(len(coded)), counts), np.repeat(np.cumsum(counts) - counts, counts)
            part = np.arange(len(doc)) - first
            h = h.to_numpy()
            number = h.view(np.uint64)
            number = np.where(copy > 0, _mixed(number ^ _mixed(copy.astype(np.uint64), key), key), number)
            image = permuted((number[doc] % np.uint64(hashes)) * np.uint64(parts) + part.astype(np.uint64), domain, key)
            for i in range(0, len(doc), 20_000):
                d, p, own = doc[i : i + 20_000], part[i : i + 20_000], image[i : i + 20_000]
                body = [coded[x][2 * length * y : 2 * length * (y + 1)] for x, y in zip(d.tolist(), p.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(own // per_shard), pa.array(own), pa.array(h[d]), ids.take(pa.array(d)), pa.array(p * length), pa.array(body, pa.binary())], ["shard", "image", "hash", "doc_id", "start", "ids"])

    dealt = numbered(docs).mapInArrow(deal, "shard long, image long, hash long, doc_id long, start long, ids binary")
    tasks = max(1, min(shards, 200_000))
    ranged = dealt.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int")).sortWithinPartitions("image", "hash")

    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(out)
        store.create_dir(base, recursive=True)
        file = Shard(store, base, length)
        for batch in batches:
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shard", "doc_id", "start", "ids"))):
                file.add(*row)
            yield file.taken()
        file.close()
        yield file.taken()

    written = stage(ranged.mapInArrow(write, INDEX), "tokens-index")
    counts = stage(written.groupBy("shard").count().withColumn("group", F.floor(F.col("shard") / SHARDS_PER_GROUP)), "tokens-counts")
    groups = counts.groupBy("group").agg(F.sum("count").alias("n"))
    earlier = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A row for each SHARDS_PER_GROUP shards, so the window without partitions sees few.
    groups = groups.select("group", earlier(Window.orderBy("group"), "n").alias("sofar"))
    index = counts.join(small(groups), "group").select("shard", "count", (F.col("sofar") + earlier(Window.partitionBy("group").orderBy("shard"), "count")).alias("before"))
    index.write.parquet(f"{out}/index")
    index = spark.read.schema(index.schema).parquet(f"{out}/index")
    _describe(out, {"sequences": index.agg(F.sum("count")).first()[0] or 0, "length": length, "key": key, "end": END, "dtype": "<u2"})
    slots = written.join(small(index), "shard").select((F.col("before") + F.col("place")).alias("slot"), "shard", "byte_offset", "n_tokens", "pieces", "sha256")
    return slots, out


def _describe(out: str, facts: dict) -> None:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(out)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/facts.json") as f:
        f.write(json.dumps(facts).encode())


def read_slots(out: str, start: int, n: int) -> np.ndarray:
    """Sequences of slots start..start+n-1, one row each, read at their byte offsets."""
    from pyarrow import dataset, fs

    store, base = fs.FileSystem.from_uri(out)
    facts = json.loads(store.open_input_stream(f"{base}/facts.json").read())
    length, rows = facts["length"], []
    field = dataset.field
    index = dataset.dataset(f"{base}/index", filesystem=store, format="parquet", schema=pa.schema([("shard", pa.int64()), ("count", pa.int64()), ("before", pa.int64())]))
    met = index.to_table(filter=(field("before") < start + n) & (field("before") + field("count") > start)).sort_by("before")
    for shard, size, first in zip(*(c.to_pylist() for c in met.columns)):
        low, high = max(start, first), min(start + n, first + size)
        with store.open_input_file(f"{base}/shard-{shard:08d}.bin") as f:
            rows.append(np.frombuffer(f.read_at((high - low) * length * 2, (low - first) * length * 2), facts["dtype"]).reshape(-1, length))
    return np.concatenate(rows) if rows else np.zeros((0, length), facts["dtype"])


def digests(docs: DataFrame) -> DataFrame:
    return materialise(docs)[0]
