"""Tables kept as parts, each replaced as a whole or not at all.

A commit writes its parts under a name of its own, reads them back, holds rows and an order-free digest of each
against what was expected, and only then publishes: a new list of parts, as the next version, in one atomic step that
fails if somebody else took that version meanwhile (then the list is made again from theirs). A crash anywhere leaves
the parts that were there, or the new ones; what it wrote meanwhile is never read, and ``vacuum`` removes it. Lists have
a row for each part; Spark reads, writes and digests the parts, however many a commit has, in one job each."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import release

#: Lists of parts.
LISTED = "part string, rows long, digest string, checksum string, fingerprint string, generation string"
#: Attempts at a version before a commit gives up.
ATTEMPTS = 20


class Refused(RuntimeError):
    """What was written is not what was expected; nothing was published."""


def workspace(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; only a local session may lack it."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
        named = sc.getCheckpointDir()
    return named


def row_digest(columns: list[str]) -> Column:
    """Of one row: its columns as JSON, nulls told from absent text."""
    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(columns))), {"ignoreNullFields": "false"})
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)")


def digests(frame: DataFrame, by: str = "part") -> DataFrame:
    """part, rows and digest of ``frame``: a sum over rows, so it depends on no order and merges in every task."""
    columns = [c for c in frame.columns if c != by]
    total = F.pmod(F.sum(row_digest(columns)), F.lit(2**60).cast("decimal(38,0)"))
    return frame.groupBy(F.col(by).cast("string").alias("part")).agg(F.count("*").alias("rows"), total.cast("string").alias("digest"))


class Parts:
    """A table of parts below ``root``."""

    def __init__(self, spark: SparkSession, root: str, after: Callable[[str], None] = lambda step: None):
        self.spark, self.root, self.after = spark, root, after

    def version(self) -> int:
        """The last version's number; 0 before the first."""
        fs, folder = release._fs(self.spark, f"{self.root}/versions")
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def listed(self, version: int | None = None) -> DataFrame:
        """The parts of a version, by default of the last one."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], LISTED)
        facts = json.loads(release._read_text(self.spark, f"{self.root}/versions/{version:012d}.json"))
        return self.spark.read.schema(LISTED).parquet(f"{self.root}/{facts['list']}")

    def read(self, names: list[str] | None = None, version: int | None = None) -> DataFrame | None:
        """All rows, or those of some parts, with their ``part``; only these parts' files are read. None without any part."""
        rows = self.listed(version)
        rows = rows if names is None else rows.where(F.col("part").isin(names))
        found = sorted((r.generation, r.part) for r in rows.where("rows > 0").select("generation", "part").collect())  # a row for each part
        if not found:
            return None
        out = None
        for generation in dict.fromkeys(g for g, _ in found):
            base = f"{self.root}/data/{generation}"
            paths = [f"{base}/part={_escaped(p)}" for g, p in found if g == generation]
            frame = self.spark.read.option("basePath", base).parquet(*paths).withColumn("part", F.col("part").cast("string"))
            out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
        return out

    def commit(self, frame: DataFrame, expected: DataFrame, gone: list[str] | None = None, fingerprint: str = "") -> int:
        """Replaces the parts that ``expected`` names (part, rows and, if known, digest and checksum) by the rows of ``frame``
        (with ``part``), and drops the parts ``gone``; the version that says so."""
        generation = uuid.uuid4().hex
        path = f"{self.root}/data/{generation}"
        expected = expected.select(F.col("part").cast("string").alias("part"), "rows", *((F.col(c) if c in expected.columns else F.lit(None)).cast("string").alias(c) for c in ("digest", "checksum")))
        # Rows of a part meet, so that files are few; a part with many rows is split again by size.
        frame.hint("rebalance", "part").write.partitionBy("part").parquet(path)
        self.after("staged")
        # Read by the schema it was written with; partition values stay text.
        written = self.spark.read.schema(frame.schema).parquet(path)
        found = digests(written).withColumnsRenamed({"rows": "found_rows", "digest": "found_digest"})
        both = expected.join(found, "part", "full")
        same = (F.col("rows") == F.coalesce("found_rows", F.lit(0))) & (F.col("digest").isNull() | (F.col("digest") == F.col("found_digest")))
        new = both.select("part", "rows", F.coalesce("found_digest", F.lit("0")).alias("digest"), "checksum", F.lit(fingerprint).alias("fingerprint"), F.lit(generation).alias("generation"), F.coalesce(same, F.lit(False)).alias("same"))
        lists = f"lists/{generation}"
        new.write.parquet(f"{self.root}/{lists}-new")
        new = self.spark.read.schema(new.schema).parquet(f"{self.root}/{lists}-new")
        broken = [r.part for r in new.where("not same").orderBy("part").limit(5).collect()]
        if broken:
            raise Refused(f"not as expected: {', '.join(broken)}")
        self.after("verified")
        return self._publish(new.drop("same"), gone or [], lists)

    def commit_list(self, rows: DataFrame | None, gone: list[str] | None = None, fingerprint: str = "") -> int:
        """A version that lists ``rows`` (part, rows, checksum; nothing is stored of them) and not the parts ``gone``."""
        new = self.spark.createDataFrame([], LISTED) if rows is None else rows.select("part", "rows", F.lit("0").alias("digest"), "checksum", F.lit(fingerprint).alias("fingerprint"), F.lit("").alias("generation"))
        return self._publish(new, gone or [], f"lists/{uuid.uuid4().hex}")

    def _publish(self, new: DataFrame, gone: list[str], lists: str) -> int:
        for attempt in range(ATTEMPTS):
            version = self.version()
            kept = self.listed(version).join(new.select("part"), "part", "left_anti")
            kept = kept.where(~F.col("part").isin(gone)) if gone else kept
            kept.unionByName(new).coalesce(1).write.parquet(f"{self.root}/{lists}-{attempt}")  # a row for each part
            self.after("listed")
            if release.create_once(self.spark, f"{self.root}/versions/{version + 1:012d}.json", json.dumps({"list": f"{lists}-{attempt}"})):
                self.after("published")
                return version + 1
        raise Refused("others commit all the time")

    def vacuum(self) -> int:
        """Removes what no part of the last version uses; the number of generations removed. Not while others read older versions."""
        used = {r.generation for r in self.listed().select("generation").distinct().collect()}
        fs, folder = release._fs(self.spark, f"{self.root}/data")
        unused = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in used] if fs.exists(folder) else []
        for p in unused:
            fs.delete(p, True)
        return len(unused)


def _escaped(value: str) -> str:
    """A partition value as the writer spells it in a path."""
    from pyspark import SparkContext

    return SparkContext._active_spark_context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
