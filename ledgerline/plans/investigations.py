"""Investigations as an append-only log: every change is a row, the latest row of an id is its state.

A change names the version it was made from; one made from an older version is refused. Each version of an id is a file
of its own that is created only if it is not there, so of two changes made at once one is refused. Each row carries
hashes of the state before and after, so the audit trail can be checked without trusting the log's order."""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import release

SCHEMA = "investigation_id string, version int, action string, actor string, at string, title string, owner string, priority string, status string, summary string, resolution string, contract_id string, filter_context string, before_sha256 string, after_sha256 string"
#: Fixed values.
STATUSES = ("open", "in_progress", "resolved")
PRIORITIES = ("low", "medium", "high")
MUTABLE = ("title", "owner", "priority", "status", "summary", "resolution")
STATE = (*MUTABLE, "contract_id", "filter_context")
LIMITS = {"title": 200, "owner": 120, "summary": 4000, "resolution": 4000, "actor": 120}


class Invalid(ValueError):
    """A change that may not be made."""


def digest(value: Any) -> str | None:
    return None if value is None else hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _checked(state: dict[str, Any]) -> dict[str, Any]:
    if state["status"] not in STATUSES:
        raise Invalid("unknown status")
    if state["priority"] not in PRIORITIES:
        raise Invalid("unknown priority")
    if not (state["title"] or "").strip():
        raise Invalid("a title is required")
    if state["status"] == "resolved" and not (state["resolution"] or "").strip():
        raise Invalid("a resolution is required")
    for name, most in LIMITS.items():
        if len(state.get(name) or "") > most:
            raise Invalid(f"{name} is too long")
    return state


class Store:
    """The log below ``path``: reads are Spark reads of its files, a change creates one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).json(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def current(self, status: str | None = None) -> DataFrame:
        """The latest row of each id, of one status if asked for."""
        if status is not None and status not in STATUSES:
            raise Invalid("unknown status")
        order = Window.partitionBy("investigation_id").orderBy(F.col("version").desc())
        latest = self.log().withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")
        return latest.where(F.col("status") == status) if status else latest

    def audit(self, investigation_id: str) -> DataFrame:
        return self.log().where(F.col("investigation_id") == investigation_id).orderBy("version")

    def broken_chain(self) -> DataFrame:
        """Rows whose hash before isn't the hash after of the version before; none, if all is well."""
        order = Window.partitionBy("investigation_id").orderBy("version")
        return self.log().withColumn("prior", F.lag("after_sha256").over(order)).where("not (prior <=> before_sha256)")

    def create(self, title: str, contract_id: str, filter_context: dict[str, Any], actor: str, owner: str = "", priority: str = "medium", summary: str = "") -> str:
        state = {"title": title, "owner": owner or actor, "priority": priority, "status": "open", "summary": summary, "resolution": "", "contract_id": contract_id, "filter_context": json.dumps(filter_context, sort_keys=True)}
        _checked(state | {"actor": actor})
        new = str(uuid.uuid4())
        self._append(new, 1, "create", actor, None, state)
        return new

    def update(self, investigation_id: str, version: int, changes: dict[str, Any], actor: str) -> int:
        if not changes or set(changes) - set(MUTABLE):
            raise Invalid("only " + ", ".join(MUTABLE) + " may change")
        row = self.current().where(F.col("investigation_id") == investigation_id).first()
        if row is None:
            raise Invalid("no such investigation")
        if row["version"] != version:
            raise Invalid("changed by somebody else meanwhile")
        before = {n: row[n] for n in STATE}
        self._append(investigation_id, version + 1, "update", actor, before, _checked(before | changes))
        return version + 1

    def _append(self, investigation_id: str, version: int, action: str, actor: str, before: dict | None, after: dict) -> None:
        values = (investigation_id, version, action, actor, datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), *(after[n] for n in STATE), digest(before), digest(after))
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        if not release.create_once(self.spark, f"{self.path}/{investigation_id}/{version:09d}.json", json.dumps(dict(zip(names, values)))):
            raise Invalid("changed by somebody else meanwhile")
