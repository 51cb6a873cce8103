"""Archives as they arrive: each micro-batch is conformed, published and joined, and what it makes late is repaired.

Every step replaces parts that are named by source file or month, so a batch that broke off anywhere, or comes twice, ends
as if it had come once; the stream's checkpoint says which archives are through. Securities that come after their
loans repair these, so the order of batches does not matter."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import population
from ..plans import conformance, repair
from ..plans.parts import Parts
from ..sources import archives

FILES = "path string, modificationTime timestamp, length long, content binary"


def conform_batch(spark: SparkSession, paths: list[str], contract: Mapping[str, Any], aliases: Mapping[str, Mapping[str, list[str]]], root: str, after: Callable[[str], None] = lambda step: None) -> None:
    """Conforms some archives, publishes them below ``root`` and brings the joined loans (``root``/joined) up to date."""

    def keep(frame: DataFrame) -> DataFrame:
        return archives.stored(frame, f"{root}/building")

    lines = keep(archives.lines_of(archives.zip_stream(spark, *paths)))
    found = conformance.conform(lines, keep(archives.inventory(lines, contract)), aliases, keep=keep)
    conformance.write(found, root, after)
    own = [r.source_file for r in found.manifest.select("source_file").collect()]  # a row for each archive of the batch
    others = [r.part for r in Parts(spark, f"{root}/securities").listed().where("rows > 0").select("part").collect() if r.part not in own]
    columns = ["security_id", "report_period", "security_status"]
    none = spark.createDataFrame([], "security_id string, report_period string, security_status string")
    of = lambda files: frame.select(*columns) if files and (frame := Parts(spark, f"{root}/securities").read(files)) is not None else none
    before, new = of(others), of(own)
    store = repair.JoinedLoans(spark, f"{root}/joined", after)
    if not new.isEmpty():
        store.repair(before, new)
    after("repaired")
    loans = Parts(spark, f"{root}/loans").read()
    if loans is not None:
        months = [r.report_period for r in found.loans.select("report_period").distinct().collect()]
        if months:
            store.publish(population.join_reason(loans.where(F.col("report_period").isin(months)).drop("part", "join_reason"), before.unionByName(new)))


def conformed_stream(spark: SparkSession, path: str, contract: Mapping[str, Any], aliases: Mapping[str, Mapping[str, list[str]]], root: str, checkpoint: str, files_per_batch: int = 100, after: Callable[[str], None] = lambda step: None, **trigger: Any) -> StreamingQuery:
    """Starts the stream of archives below ``path``; ``trigger`` as for ``writeStream.trigger``, by default all there are now."""
    files = spark.readStream.schema(FILES).format("binaryFile").option("pathGlobFilter", "*.zip").option("maxFilesPerTrigger", files_per_batch).load(path)

    def batch(frame: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in frame.select("path").collect()]  # ``files_per_batch`` at most
        if paths:
            conform_batch(spark, paths, contract, aliases, root, after)

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
