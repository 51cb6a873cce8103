"""Archive and text sources: lines with file, member and line number; inventory of what is there."""

from __future__ import annotations

import hashlib
import io
import os
import re
import uuid
import zipfile
from collections.abc import Mapping
from typing import Any

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import population
from . import contracts

LINES = "file string, member string, line long, value string, error string"
_BATCH = 20_000


def zip_lines(spark: SparkSession, *paths: str, pattern: str = "*.zip") -> DataFrame:
    """Lines of one-member ZIP files, inflated as a stream in the executors; a file that cannot be read gives one row
    with ``error``. Each archive is one task's work, as its deflate stream cannot be split.

    Where executors can open the store themselves, only paths go through Spark and each archive is read as it is
    inflated; in a store that only Spark reads, archives come with their bytes, one to a batch."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(list(paths))
    if all(map(_reachable, paths)):
        return files.select("path").mapInArrow(_streamed, LINES)
    return files.select("path", "content").mapInArrow(_held, LINES)


#: What is known of an archive once all of it was read; ``keys_blake2b``: of all lines' leading cells, in order.
DIGESTS = "file string, member string, size long, sha256 string, member_size long, member_sha256 string, keys_blake2b string, lines long, error string"
#: Leading cells of a line that its key hash takes.
KEY_CELLS = 3


def zip_stream(spark: SparkSession, *paths: str, pattern: str = "*.zip") -> DataFrame:
    """Lines of archives as ``zip_lines`` gives them and, from the same task, one row for each archive with
    its digests (``digest``, null on lines): stored once, ``lines_of`` and ``digests_of`` give either.

    One task reads an archive's bytes for its own SHA-256 and inflates it, which gives lines, the member's SHA-256 and
    the keys' BLAKE2b; nothing is held but a block."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(list(paths))
    schema = f"{LINES}, digest struct<{DIGESTS.replace(' ', ':')}>".replace(",:", ", ")
    if all(map(_reachable, paths)):
        return files.select("path").mapInArrow(_digested_paths, schema)
    return files.select("path", "content").mapInArrow(_digested_held, schema)


def lines_of(stream: DataFrame) -> DataFrame:
    """Lines, and a row with ``error`` for each archive that cannot be read."""
    return stream.where("digest is null or digest.error is not null").select("file", "member", "line", "value", F.coalesce("error", "digest.error").alias("error"))


def digests_of(stream: DataFrame) -> DataFrame:
    return stream.where("digest is not null").select("digest.*")


class _Hashed(io.RawIOBase):
    """A member as it is inflated: passes its bytes on, and hashes them."""

    def __init__(self, raw):
        self.raw, self.sha, self.size = raw, hashlib.sha256(), 0

    def readable(self):
        return True

    def readinto(self, into):
        got = self.raw.read(len(into))
        into[: len(got)] = got
        self.sha.update(got)
        self.size += len(got)
        return len(got)


def _with_digests(path: str, source):
    """Lines, then the archive's row; of one that cannot be read only that."""
    name = path.rsplit("/", 1)[-1]
    sha, size = hashlib.sha256(), 0
    while block := source.read(1 << 20):
        sha.update(block)
        size += len(block)
    source.seek(0)
    keys, found, member, n, error = hashlib.blake2b(digest_size=32), None, None, 0, None
    try:
        archive = zipfile.ZipFile(source)
        members = archive.infolist()
        if len(members) != 1:
            error = f"expected one member, found {len(members)}"
        elif members[0].flag_bits & 1:
            member, error = members[0].filename, "member is encrypted"
        else:
            member = members[0].filename
            with archive.open(members[0]) as raw:
                found = _Hashed(raw)
                for n, line in enumerate(io.TextIOWrapper(io.BufferedReader(found, 1 << 16), "utf-8-sig", newline=""), 1):
                    value = line.rstrip("\r\n")
                    keys.update("|".join(value.split("|", KEY_CELLS)[:KEY_CELLS]).encode() + b"\n")
                    yield name, member, n, value, None, None
    except (zipfile.BadZipFile, ValueError, OSError) as e:
        error = f"{'UnicodeDecodeError' if isinstance(e, UnicodeDecodeError) else 'BadZipFile'}: cannot be read"
    whole = error is None
    yield name, member, None, None, None, {"file": name, "member": member, "size": size, "sha256": sha.hexdigest(), "member_size": found.size if whole else None, "member_sha256": found.sha.hexdigest() if whole else None, "keys_blake2b": keys.hexdigest() if whole else None, "lines": n, "error": error}


def _digested_paths(batches):
    from pyarrow import fs

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            with store.open_input_file(at) as f:
                yield from _batched(_with_digests(path, f), _digest_batch)


def _digested_held(batches):
    for batch in batches:
        for i in range(len(batch)):
            yield from _batched(_with_digests(batch.column(0)[i].as_py(), pa.BufferReader(batch.column(1)[i].as_buffer())), _digest_batch)


def _digest_batch(rows):
    kinds = {"string": pa.string(), "long": pa.int64()}
    struct = pa.struct([(n, kinds[k]) for n, k in (c.split() for c in DIGESTS.split(", "))])
    lines = _batch([r[:5] for r in rows])
    return pa.RecordBatch.from_arrays([*lines.columns, pa.array([r[5] for r in rows], struct)], [*lines.schema.names, "digest"])


def _reachable(path: str) -> bool:
    from pyarrow import fs

    try:
        store, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")
        return store.get_file_info(at).type != fs.FileType.NotFound
    except (ValueError, OSError):
        return False


def _streamed(batches):
    from pyarrow import fs

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            with store.open_input_file(at) as f:
                yield from _batched(_lines(path, f))


def _held(batches):
    for batch in batches:
        for i in range(len(batch)):
            yield from _batched(_lines(batch.column(0)[i].as_py(), pa.BufferReader(batch.column(1)[i].as_buffer())))


def stored(frame: DataFrame, work: str) -> DataFrame:
    """``frame`` written below ``work`` and read again, for what is read several times."""
    path = f"{work}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _lines(path: str, source):
    name = path.rsplit("/", 1)[-1]
    try:
        archive = zipfile.ZipFile(source)
        members = archive.infolist()
        if len(members) != 1:
            yield name, None, None, None, f"expected one member, found {len(members)}"
            return
        if members[0].flag_bits & 1:
            yield name, members[0].filename, None, None, "member is encrypted"
            return
        with archive.open(members[0]) as raw:
            for n, line in enumerate(io.TextIOWrapper(raw, "utf-8-sig", newline=""), 1):
                yield name, members[0].filename, n, line.rstrip("\r\n"), None
    except (zipfile.BadZipFile, ValueError, OSError) as e:  # ValueError: text that is not UTF-8, seeks beyond a cut file
        yield name, None, None, None, f"{'UnicodeDecodeError' if isinstance(e, UnicodeDecodeError) else 'BadZipFile'}: cannot be read"


def _batched(rows, batch=None):
    held, batch = [], batch or _batch
    for row in rows:
        held.append(row)
        if len(held) == _BATCH:
            yield batch(held)
            held = []
    if held:
        yield batch(held)


def _batch(rows):
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["file", "member", "line", "value", "error"])


def text_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Lines of text files, in the form of ``zip_lines``.

    Files are read in splits. The lines of each split are counted first; what lies in the splits before it is a running
    sum over splits, so that lines are numbered where they are read and a large file needs no task of its own."""
    from pyspark.sql import Window

    raw = spark.read.option("pathGlobFilter", pattern).text(path)
    raw = raw.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.rtrim("value", F.lit("\r")).alias("value"))
    # A row for each split. Its lines lie side by side in one task, so their ids do.
    splits = raw.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "block", (before - F.col("first") + 1).alias("shift"))
    out = raw.join(splits, ["file", "block"]).withColumn("line", F.col("at") + F.col("shift"))
    value = F.when(F.col("line") == 1, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    return out.select("file", F.col("file").alias("member"), "line", value.alias("value"), F.lit(None).cast("string").alias("error"))


def widest(lines: DataFrame, separator: str) -> int:
    """Cells of the widest line at most, quotes apart; 1 without lines."""
    found = lines.agg(F.max(F.length("value") - F.length(F.replace("value", F.lit(separator), F.lit(""))))).first()[0]
    return (found or 0) + 1


def quoted_cells(value: Column, separator: str, most: int) -> Column:
    """Cells of a delimited line that may be quoted, ``most`` of them; null beyond the line's own."""
    parsed = F.from_csv(value, ", ".join(f"c{i} string" for i in range(most)), {"sep": separator})
    return F.array(*(parsed[f"c{i}"] for i in range(most)))


def gzip_partitions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Gzipped CSV partitions; a gzip file is one task, so publish as Parquet for anything read twice."""
    return spark.read.schema(schema).option("header", True).csv(path)


def cells(value: Column, separator: str = "|") -> Column:
    """All cells of a raw line, trailing blanks included, so that widths can be checked before any cast."""
    return F.split(value, re.escape(separator), -1)


def headers(lines: DataFrame, separator: str = "|") -> DataFrame:
    """file, header, width and hash of each first line."""
    first = lines.where("line = 1")
    header = cells(F.col("value"), separator)
    return first.select("file", "member", header.alias("header"), F.size(header).alias("width"), population.header_hash(header).alias("header_sha256"))


def body(lines: DataFrame, separator: str = "|") -> DataFrame:
    """Data lines with their cells; ``bad_width`` where they are not as many as the header's."""
    head = headers(lines, separator).select("file", "width")
    rows = lines.where("line > 1").withColumn("cells", cells(F.col("value"), separator))
    return rows.join(head, "file").withColumn("bad_width", F.size("cells") != F.col("width"))


def aliased(cells_: Column, header: Column, names: list[str]) -> Column:
    """The cell under the first alias that the header has; empty if none."""
    out = F.lit("")
    for name in reversed(names):
        at = F.array_position(header, name)
        out = F.when(at > 0, F.get(cells_, (at - 1).cast("int"))).otherwise(out)
    return out


def matched(files: DataFrame, families) -> DataFrame:
    """``files`` plus the family whose file-name pattern fits, the report period that the name gives, and how many fit."""
    family, period, matches = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(0)
    for f in families:
        pattern = re.sub(r"\(\?P<(\w+)>", r"(?<\1>", f["pattern"])
        at = re.compile(f["pattern"]).groupindex
        hit = F.col("file").rlike(pattern)
        matches = matches + hit.cast("int")
        family = F.when(hit, F.lit(f["id"])).otherwise(family)
        year = F.regexp_extract("file", pattern, at["year"])
        period = F.when(hit, F.concat(F.when(F.length(year) == 2, F.lit("20")).otherwise(F.lit("")), year, F.lit("-"), F.regexp_extract("file", pattern, at["month"]))).otherwise(period)
    return files.withColumns({"family": family, "report_period": period, "matches": matches})


def inventory(lines: DataFrame, contract: Mapping[str, Any], separator: str = "|", heads: DataFrame | None = None) -> DataFrame:
    """One row for each file: family, report_period, schema_version, line counts and what blocks its use.

    Families match by file name, versions by header hash inside their window; a version without a header hash has a
    layout (width of each record type) that all of the file's records must have. Anything but one match blocks.
    ``heads``: ``headers`` of the lines, if they are stored."""
    spark = lines.sparkSession
    # Lines are counted by hash, errors as part of the key; of these few rows a file's error is taken.
    files = lines.groupBy("file", "error").agg(F.count("value").alias("lines"))
    files = files.groupBy("file").agg(F.sum("lines").alias("lines"), F.first("error", ignorenulls=True).alias("error"))
    files = matched(files, contract["families"])
    heads = (headers(lines, separator) if heads is None else heads).select("file", "width", "header_sha256")
    w = contracts.windows(spark, contract).withColumnRenamed("family", "of").withColumnRenamed("header_sha256", "known")
    joined = files.join(heads, "file", "left").join(F.broadcast(w), (F.col("family") == F.col("of")) & (F.col("known").isNull() | (F.col("known") == F.col("header_sha256"))) & F.col("report_period").between(F.coalesce("period_min", F.lit("")), F.coalesce("period_max", F.lit("9999-99"))), "left")
    if any(v.get("layouts") for f in contract["families"] for v in f["schema_versions"]):
        laid = contracts.layouts(spark, contract)
        each = population.profile(lines, re.escape(separator)).join(files.select("file", "family"), "file").join(F.broadcast(laid.select("family", "schema_version").distinct()), "family")
        odd = each.join(F.broadcast(laid), ["family", "schema_version", "record_type", "width"], "left_anti").select("file", F.col("schema_version").alias("odd")).distinct()
        joined = joined.alias("j").join(odd.alias("o"), (F.col("j.file") == F.col("o.file")) & (F.col("j.schema_version") == F.col("o.odd")) & F.col("j.known").isNull(), "left")
        joined = joined.withColumn("schema_version", F.when(F.col("odd").isNull(), F.col("j.schema_version"))).drop(F.col("o.file"), "odd")
    out = joined.groupBy("file", "lines", "error", "family", "report_period", "matches", "width", "header_sha256").agg(F.count("schema_version").alias("fits"), F.min("schema_version").alias("schema_version"), F.min("column_count").alias("column_count"))
    blocker = (
        F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("matches") == 0, "no family matches").when(F.col("matches") > 1, "several families match")
        .when(F.col("fits") != 1, "no single schema version fits").when(F.col("column_count") != F.col("width"), "column count differs from the contract")
    )
    return out.withColumn("blocker", blocker).drop("matches", "fits", "column_count")


def inventory_cached(spark: SparkSession, path: str, contract: Mapping[str, Any], cache: str, pattern: str = "*.zip") -> DataFrame:
    """The inventory of ``path``, with the digests of each archive; archives that ``cache`` knows are not read.

    An archive is known by name, size, time and contract, or else by name and SHA-256 under this contract: one that was
    touched but holds the same bytes is hashed and not inflated. The cache is a table of parts, one for each archive, so two
    runs at once or a run that breaks off neither repeat nor lose a row, and archives that are gone leave it. Lines are kept
    for this run only."""
    from ..plans import release
    from ..plans.parts import Parts, digests

    signature = contracts.fingerprint(contract)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "path")
    files = spark.createDataFrame(files.collect(), files.schema)  # one row for each archive
    table = Parts(spark, cache)
    known = table.read()
    known = known.where(F.col("signature") == signature) if known is not None else None
    seen = set() if known is None else {tuple(r) for r in known.select("file", "size", "modified").collect()}
    touched = [r for r in files.collect() if (r.file, r.size, r.modified) not in seen]
    new, same = [r.path for r in touched], None
    if touched and known is not None:
        hashed = spark.createDataFrame([(r.path,) for r in touched], "path string").repartition(len(touched)).mapInArrow(_hashes, "file string, now string")
        hashed = spark.createDataFrame(hashed.collect(), "file string, now string") if all(map(_reachable, [path])) else None
        if hashed is not None:
            same = known.join(hashed, (known["file"] == hashed["file"]) & (known["sha256"] == hashed["now"]), "left_semi").drop("size", "modified").join(files.drop("path"), "file")
            equal = {r.file for r in same.select("file").collect()}
            new = [r.path for r in touched if r.file not in equal]
    gone = sorted({r.part for r in table.listed().collect()} - {r.file for r in files.select("file").collect()})
    made = same
    if new:
        stream = stored(zip_stream(spark, *new, pattern=pattern), f"{cache}/reading")
        found = inventory(lines_of(stream), contract).drop("member").join(digests_of(stream).drop("size", "lines", "error"), "file").join(files.drop("path"), "file").withColumn("signature", F.lit(signature))
        made = found if made is None else made.drop("part").select(found.columns).unionByName(found)
    if made is not None and (new or same is not None):
        kept = release.staged((made.drop("part") if "part" in made.columns else made).withColumn("part", F.col("file")), f"{cache}/building")
        table.commit(kept, digests(kept), gone)
    elif gone:
        table.commit_list(None, gone)
    found = table.read()
    if found is None:
        empty = stored(zip_stream(spark, path, pattern=pattern), f"{cache}/reading")
        found = inventory(lines_of(empty), contract).join(digests_of(empty).drop("size", "lines", "error"), "file")
    return found.drop("part", "modified", "signature")


def _hashes(batches):
    from pyarrow import fs

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            sha = hashlib.sha256()
            with store.open_input_stream(at) as f:
                while block := f.read(1 << 20):
                    sha.update(block)
            yield pa.RecordBatch.from_pydict({"file": [path.rsplit("/", 1)[-1]], "now": [sha.hexdigest()]})


class NotReady(RuntimeError):
    """Months of a required family are missing."""


def require_ready(found: DataFrame) -> DataFrame:
    """``readiness``, if every expected month has a usable file; else an error that names the first that has none."""
    missing = found.where("received = 0").orderBy("family", "report_period").first()
    if missing is not None:
        raise NotReady(f"{missing.family} has no usable file of {missing.report_period}")
    return found


def readiness(files: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """Expected months of each family with the usable files found; zero blocks a release."""
    w = contracts.windows(files.sparkSession, contract).where("period_min is not null and period_max is not null").select("family", "period_min", "period_max")
    return population.completeness(w, files.where("blocker is null").select("family", "report_period"))
