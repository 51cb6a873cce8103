"""Source contracts: families of files, their schema versions and validity windows, as JSON on the driver.

A contract names families with an id, a file-name pattern (with groups ``year`` and ``month``), a kind
(``headered`` or ``headerless``), a separator and schema versions; each version has a header hash or record
layouts, a column count and a window of report months."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


class ContractError(ValueError):
    """A contract that cannot be used."""


def load(path: str) -> dict[str, Any]:
    """One contract; a ``defaults`` object fills what a family leaves out."""
    contract = json.loads(Path(path).read_text())
    defaults = contract.get("defaults", {})
    contract["families"] = [defaults | f for f in contract.get("families", [])]
    validate(contract)
    return contract


def bundle(paths: Iterable[str]) -> dict[str, Any]:
    """Several contracts as one; a family may appear once."""
    families = [f for p in paths for f in load(p)["families"]]
    out = {"families": families}
    validate(out)
    return out


def validate(contract: Mapping[str, Any]) -> None:
    families = contract.get("families") or []
    if not families:
        raise ContractError("no families")
    ids = [f.get("id") for f in families]
    if len(set(ids)) != len(ids) or None in ids:
        raise ContractError("family ids must be there and differ")
    for f in families:
        pattern = re.compile(f["pattern"])
        if not {"year", "month"} <= set(pattern.groupindex):
            raise ContractError(f"{f['id']}: the pattern needs groups year and month")
        if f.get("kind", "headered") not in ("headered", "headerless"):
            raise ContractError(f"{f['id']}: unknown kind")
        versions = f.get("schema_versions") or []
        if not versions:
            raise ContractError(f"{f['id']}: no schema versions")
        for v in versions:
            low, high = v.get("period_min"), v.get("period_max")
            if low and high and low > high:
                raise ContractError(f"{f['id']}: window ends before it starts")
            if f.get("kind", "headered") == "headered" and not v.get("header_sha256"):
                raise ContractError(f"{f['id']}: a headered version needs its header's hash")
            if f.get("kind") == "headerless" and not v.get("layouts"):
                raise ContractError(f"{f['id']}: a headerless version needs layouts")


def windows(spark: SparkSession, contract: Mapping[str, Any]) -> DataFrame:
    """family, schema_version, period_min, period_max, header_sha256, column_count."""
    rows = [(f["id"], v["version"], v.get("period_min"), v.get("period_max"), v.get("header_sha256"), v.get("column_count")) for f in contract["families"] for v in f["schema_versions"]]
    return spark.createDataFrame(rows, "family string, schema_version string, period_min string, period_max string, header_sha256 string, column_count int")


def layouts(spark: SparkSession, contract: Mapping[str, Any]) -> DataFrame:
    """family, schema_version, record_type, width: what the records of versions without a header may look like."""
    rows = [(f["id"], v["version"], str(t), int(w)) for f in contract["families"] for v in f["schema_versions"] for t, w in (v.get("layouts") or {}).items()]
    return spark.createDataFrame(rows, "family string, schema_version string, record_type string, width int")


def header_sha256(header: Iterable[str]) -> str:
    return hashlib.sha256("|".join(header).encode()).hexdigest()


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def fingerprint(*parts: Any) -> str:
    """Of contracts, parser versions and formats: a change asks for a rebuild."""
    return hashlib.sha256(canonical(parts).encode()).hexdigest()


def field_positions(header: list[str], fields: Iterable[Mapping[str, Any]]) -> dict[str, int | None]:
    """Target -> place of the first alias that the header has."""
    return {f["target"]: next((header.index(n) for n in f["source_names"] if n in header), None) for f in fields}


def denied_keys(value: Any, denied: frozenset[str], path: str = "$") -> list[str]:
    """Paths of keys that must not leave, anywhere in a nested value."""
    if isinstance(value, Mapping):
        own = [f"{path}.{k}" for k in value if k.lower() in denied]
        return own + [p for k, v in value.items() for p in denied_keys(v, denied, f"{path}.{k}")]
    if isinstance(value, (list, tuple)):
        return [p for i, v in enumerate(value) for p in denied_keys(v, denied, f"{path}[{i}]")]
    return []
