"""Restricted tokens in texts: sampled from archives, sought by one automaton for all of them.

A value is read once, whatever the tokens' number and lengths: an Aho-Corasick automaton of up to ``SHARD`` tokens is built in
each task, and larger sets of tokens take a pass over the values for each shard of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import archives

#: Headers whose cells must not leave, and the shortest token and the rows of an archive that are sampled.
RESTRICTED = ("Security Identifier", "Loan Identifier", "CUSIP", "Seller Name", "Servicer Name")
LEAST = 5
SAMPLED = 25
#: Tokens of one automaton: some hundred bytes each.
SHARD = 200_000


def sampled_tokens(lines: DataFrame, rows: int = SAMPLED, restricted: tuple[str, ...] = RESTRICTED) -> DataFrame:
    """file, token: the restricted cells of each archive's first ``rows`` data lines. ``lines``: file, member, line, value.

    Lines carry their numbers, so the sample is a filter, not a sort."""
    heads = archives.headers(lines).select("file", "header")
    body = lines.where(F.col("line").between(2, rows + 1)).select("file", archives.cells(F.col("value")).alias("cells")).join(heads, "file")
    pairs = F.filter(F.arrays_zip("header", "cells"), lambda p: p["header"].isin(*restricted))
    tokens = body.select("file", F.explode(F.transform(pairs, lambda p: F.trim(p["cells"]))).alias("token"))
    return tokens.where(F.length("token") >= LEAST).distinct()


def leaked(tokens: DataFrame, files: DataFrame, shard: int = SHARD) -> DataFrame:
    """path, token: the tokens of ``LEAST`` characters and more that the values of ``files`` (path, value) contain."""
    sought = tokens.select(F.trim("token").alias("token")).where(F.length("token") >= LEAST).distinct()
    n = sought.count()
    out = None
    for i in range(max(1, -(-n // shard))):
        own = sought.where(F.pmod(F.xxhash64("token"), F.lit(max(1, -(-n // shard)))) == i)
        held = files.sparkSession.sparkContext.broadcast([r.token for r in own.collect()])  # about ``shard`` tokens
        part = files.select("path", "value").mapInArrow(_search(held), "path string, token string")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def _search(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for token in held.value:
            automaton.add_word(token, token)
        if not len(automaton):
            return
        automaton.make_automaton()
        for batch in batches:
            paths, found = [], []
            for path, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {token for _, token in automaton.iter(value)} if value else ()
                paths += [path] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(found, pa.string())], ["path", "token"])

    return run
