"""Releases: incremental partials, write-audit-publish, and the pointer to the current release.

A release is a directory of Parquet tables written under a name of its own; checks run on what was written,
and only then does the pointer file name it. Readers follow the pointer, so they see one release or the next."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CheckFailed(RuntimeError):
    """Written tables do not hold; the pointer stays."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Whole or not at all: written beside, then renamed over in one step, so readers find the old text or the new."""
    jvm = spark._jvm
    fs, target = _fs(spark, path)
    _, part = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    kind = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    qualified = fs.makeQualified(target)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), qualified, options)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that must not exist, whole, in one step that fails if it does: False then, and nothing changes."""
    from py4j.protocol import Py4JJavaError

    jvm = spark._jvm
    fs, target = _fs(spark, path)
    _, part = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":  # renames replace there, links don't
            at = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(at(target), at(part))
        else:
            options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
            qualified = fs.makeQualified(target)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), qualified, options)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(part, False)
    return True


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    return "\n".join(r.value for r in spark.read.text(path).collect())


def stale(manifest: DataFrame, built: DataFrame, fingerprint: str) -> DataFrame:
    """Sources whose checksum, rows or build fingerprint differ from what was built: those to build again.

    ``manifest``: source_file, checksum, rows; ``built``: the same and fingerprint."""
    same = built.where(F.col("fingerprint") == fingerprint).select("source_file", "checksum", "rows")
    return manifest.join(same, ["source_file", "checksum", "rows"], "left_anti")


def replace_partitions(partials: DataFrame, path: str, by: str = "source_file") -> None:
    """Writes partials by source file; only the files at hand are replaced."""
    partials.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def staged(frame: DataFrame, folder: str) -> DataFrame:
    """``frame`` written below ``folder`` and read again: what is read several times is computed once."""
    path = f"{folder}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Bytecode of a method that HotSpot still compiles; what Spark makes beyond it, up to its own limit, runs interpreted.
_COMPILED = ("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Plans that run meanwhile have their long projections cut into methods that the JVM compiles; the session's own
    setting stays as it was."""
    name, needed = _COMPILED
    own = spark.conf.get(name, None)
    spark.conf.set(name, needed)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, own)


def constant_columns(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Partitions in which a column that should be constant is not; then it cannot move into the path."""
    return df.groupBy(by).agg(*(F.count_distinct(c).alias(c) for c in columns)).where(" or ".join(f"{c} > 1" for c in columns))


def publish(spark: SparkSession, root: str, release: str, tables: Mapping[str, DataFrame], checks: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]], facts: Mapping[str, Any] | None = None) -> str:
    """Writes ``tables`` below ``root/release``, runs ``checks`` on them as read back, then moves the pointer.

    ``checks`` returns frames of violations; any row blocks. A release's name is used once: tables that exist are never
    written over, as readers may follow the pointer to them."""
    written = {}
    for name, df in tables.items():
        path = f"{root}/{release}/{name}"
        df.write.mode("errorifexists").parquet(path)
        written[name] = spark.read.parquet(path)
    broken = {n: k for n, v in checks(written).items() if (k := v.limit(1).count())}
    if broken:
        raise CheckFailed(", ".join(sorted(broken)))
    _write_text(spark, f"{root}/current.json", json.dumps({"release": release, "tables": sorted(tables), **(facts or {})}))
    return f"{root}/{release}"


def current(spark: SparkSession, root: str) -> dict[str, Any] | None:
    text = _read_text(spark, f"{root}/current.json")
    return json.loads(text) if text else None


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    pointer = current(spark, root)
    if pointer is None:
        raise FileNotFoundError(f"no release below {root}")
    return spark.read.parquet(f"{root}/{pointer['release']}/{name}")
