"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of characters outside these; ``bytes.split()`` splits at exactly these.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="ledgerline-"))
    return sc.getCheckpointDir()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and returns it read again: lineage ends here."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that are broadcast at most; all such rows are narrow.
SMALL_ROWS = 100_000


def small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if a count shows at most ``max_rows`` rows; else unchanged, for a shuffled join."""
    max_rows = SMALL_ROWS if max_rows is None else max_rows
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


#: Rows of one key that a join leaves in one task.
HOT_ROWS = 20_000


def spread_join(many: DataFrame, one: DataFrame, key: str, rows: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """``many`` inner-joined with ``one`` (a row for each ``key``): by broadcast if ``one`` is small; else the rows of
    a key with more than ``hot_rows`` are dealt to several tasks, each with a copy of that key's row of ``one``.

    ``rows`` bounds the rows of ``one`` where that is known; else they are counted."""
    hot_rows = hot_rows or HOT_ROWS
    if (one.limit(SMALL_ROWS + 1).count() if rows is None else rows) <= SMALL_ROWS:
        return many.join(F.broadcast(one), key)
    copies = F.ceil(F.col("count") / hot_rows).cast("int").alias("copies")
    hot = small(stage(many.groupBy(key).count().where(F.col("count") > hot_rows).select(key, copies), "hot"))
    n = F.coalesce("copies", F.lit(1))
    dealt = many.join(hot, key, "left").withColumn("deal", F.pmod(F.xxhash64(*many.columns), n)).drop("copies")
    copied = one.join(hot, key, "left").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))).drop("copies")
    return dealt.join(copied, [key, "deal"]).drop("deal")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hashable(df: DataFrame, columns: list[str]) -> list[Column]:
    """``columns`` as what a hash can be taken of: those that hold maps or variants as JSON."""
    odd = lambda kind: any(x in kind.simpleString() for x in ("map<", "variant"))
    return [F.to_json(F.struct(F.col(f"`{c}`"))) if odd(df.schema[c].dataType) else F.col(f"`{c}`") for c in columns]


def word_count(text):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column, natively and without an array of them; null counts 0."""
    kept = F.rtrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.length(F.regexp_replace(kept, rf"[{SPACE_CLASS}]*+[^{SPACE_CLASS}]++", "x")).cast("long")


Annotator = Callable[[list], list[pa.Array]]


def annotate(df: DataFrame, column: str, make: Callable[[], Annotator], fields: T.StructType, binary: bool = True) -> DataFrame:
    """``df`` plus ``fields``, which ``make()(texts)`` computes for each Arrow batch of ``column``.

    ``make`` runs once in each task; texts are bytes (str if not ``binary``) or None."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        annotator = make()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column))
            texts = texts.cast(pa.binary()) if binary else texts
            yield pa.RecordBatch.from_arrays([*batch.columns, *annotator(texts.to_pylist())], [*batch.schema.names, *fields.names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields.fields]))


class Bounded(dict):
    """A cache that empties itself when it holds ``limit`` entries; ``compute(key)`` fills it."""

    def __init__(self, compute: Callable, limit: int = 300_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.compute(key)
        return value


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
