"""Merkle manifest: a tree of SHA-256 digests for each source, and one over the sources.

Rows of a source are numbered in order of doc_id: leaves, which are narrow, are dealt by range, and counts by range
give each its place. ``BLOCK`` neighbouring leaves (16 to the third) are an aligned block: one row, which keeps
each level of its part of the tree as one string, 64 hex digits a node. Fixed-width substrings of a level are the runs
whose digests make the level above; what flanks a node in its run is its sibling segments. A block's root is a
leaf of the next round, until each source has one root; the sources' roots make the last tree. Proofs come
down the same way: what a block's root needs on its way to the root is joined to the block, and each leaf adds the
segments that flank it within.

Nothing but narrow rows (ids and 32-byte digests) is shuffled, and no task gets more than blocks of bounded
size, however large a source is. ``verify`` folds leaves of any table with this one's proofs.

Cases: null fields are ``-``, apart from empty ones; null doc_id comes first in its source, rows of one id follow
their leaf's digest, and equal rows have each a place; null source is a source and comes first; a source of one row is
its leaf; one source alone is the root; very long texts are hashed whole; an empty table gives an empty result;
other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, spread_join, stage

FAN = 16
#: Levels within a block, and its leaves.
LEVELS = 3
BLOCK = FAN**LEVELS
_HEX = 64
#: Fields of a leaf, in order: fixed values of the query's contract.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(**fields: Column) -> Column:
    """Digest of a row's fields, each after its length in bytes."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*(part(fields[k].cast("string")) for k in FIELDS)), 256)


def group_key(source: Column) -> Column:
    """A source as text that is never null and sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place in the group by ``order``, and ``n``, the group's size.

    Ranges of rows are sorted; a row's place overall is its range's offset plus its place there, and that of the
    group's first row is taken off. Equal rows are told apart by where they were read, so that ranges cut them too: no
    task sees more than a range."""
    told = rows.withColumn("salt", F.monotonically_increasing_id())
    sorted_ = told.repartitionByRange(group, *order, "salt").sortWithinPartitions(group, *order, "salt").drop("salt").withColumn("id", F.monotonically_increasing_id())
    sorted_ = stage(sorted_, f"{name}-sorted")
    part = F.shiftright("id", 33)
    # A row for each range (the writer's tasks): few.
    sizes = sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stage(sizes.select("part", (before - F.shiftleft("part", 33)).alias("offset")), f"{name}-offsets")
    placed = sorted_.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("at", F.col("id") + F.col("offset")).drop("part", "offset", "id")
    groups = stage(placed.groupBy(group).agg(F.min("at").alias("start"), F.count("*").alias("n")), f"{name}-groups")
    return spread_join(placed, groups, group).withColumn("pos", F.col("at") - F.col("start")).drop("at", "start")


def runs(level: Column, size: Column) -> Column:
    """The level above one of ``size`` nodes: digests of runs of ``FAN``, as one string."""
    width = FAN * _HEX
    return F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(size / FAN).cast("int") - 1), lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256)), "")


def block_levels(nodes: DataFrame, keep: list[str], name: str) -> DataFrame:
    """One row for each block: group, block, n, rows (pos within and ``keep`` of each node), level0 to level3, height.

    A block that is all of its group goes up until one node is left, others go up ``LEVELS`` levels."""
    inner = (F.col("pos") % BLOCK).cast("int").alias("at")
    packed = nodes.groupBy("group", F.floor(F.col("pos") / BLOCK).alias("block"), "n").agg(F.array_sort(F.collect_list(F.struct(inner, *keep, F.hex("digest").alias("digest")))).alias("rows"))
    out = packed.withColumn("level0", F.lower(F.array_join(F.col("rows.digest"), ""))).withColumn("rows", F.transform("rows", lambda r: r.dropFields("digest")))
    alone = F.col("n") <= BLOCK
    height = F.when(alone, sum(((F.col("n") > FAN**k).cast("int") for k in range(LEVELS)), F.lit(0))).otherwise(LEVELS)
    out = out.withColumn("height", height)
    for k in range(LEVELS):
        size = (F.length(f"level{k}") / _HEX).cast("int")
        out = out.withColumn(f"level{k + 1}", F.when(F.col("height") > k, runs(F.col(f"level{k}"), size)))
    return stage(out, name)


def top() -> Column:
    return F.coalesce(*(f"level{k}" for k in range(LEVELS, -1, -1)))


_PATH = "array<struct<left:string,right:string>>"


def flanks(run: Column, i: Column) -> Column:
    """What flanks node ``i`` of a run."""
    return F.struct(F.substring(run, F.lit(1), i * _HEX).alias("left"), F.substring(run, (i + 1) * _HEX + 1, (FAN - 1 - i) * _HEX).alias("right"))


def segments(run: Column) -> Column:
    """What flanks a block's run number ``run`` on its way to the block's root: array of (left, right)."""

    def of(k: int) -> Column:
        i = F.floor(run / FAN ** (k - 1)).cast("int")
        return flanks(F.substring(F.col(f"level{k}"), (i - i % FAN) * _HEX + 1, F.lit(FAN * _HEX)), i % FAN)

    return F.slice(F.array(*(of(k) for k in range(1, LEVELS))).cast(_PATH), F.lit(1), F.greatest(F.col("height") - 1, F.lit(0)))


def leaves_of(blocks: DataFrame, upper: str, others: list[str]) -> DataFrame:
    """A row for each node of ``blocks``: group, block, its row, path and ``others``. Runs come first, so that strings of a whole
    block are cut once for a run, and a run's for its nodes."""
    width = FAN * _HEX
    run = lambda i: F.struct(F.substring("level0", i * width + 1, F.lit(width)).alias("digests"), F.slice("rows", i * FAN + 1, F.lit(FAN)).alias("nodes"), F.concat(segments(i), upper).alias("rest"))
    runs_ = blocks.select("group", "block", "height", *others, F.explode(F.transform(F.sequence(F.lit(0), F.ceil(F.size("rows") / FAN).cast("int") - 1), run)).alias("run"))
    each = runs_.select("group", "block", "height", *others, "run.digests", "run.rest", F.explode("run.nodes").alias("row"))
    own = F.when(F.col("height") > 0, F.array(flanks(F.col("digests"), F.col("row.at") % FAN))).otherwise(F.array().cast(_PATH))
    return each.select("group", "block", "row", F.concat(own, "rest").alias("path"), *others)


def roots(nodes: DataFrame, keep: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks from the leaves up; and group, digest of each group's root. ``nodes``: group, pos, n, digest (binary)."""
    rounds, found = [], []
    while True:
        levels = block_levels(nodes, keep if not rounds else [], f"{name}-round{len(rounds)}")
        rounds.append(levels)
        found.append(levels.where(F.col("n") <= BLOCK).select("group", F.unhex(top()).alias("digest")))
        more = levels.where(F.col("n") > BLOCK)
        if more.isEmpty():
            break
        nodes = more.select("group", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.unhex(top()).alias("digest"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return rounds, out


def proofs(rounds: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """A row for each leaf: the first round's kept columns, ``path`` to the root (array of left, right), and the columns of
    ``above``: group, path (of the group's root), others."""
    others = [c for c in above.columns if c not in ("group", "path")]
    blocks = above
    for k in range(len(rounds) - 1, -1, -1):
        levels = rounds[k]
        # ``above`` has what lies over a group's only block; blocks of larger groups find it by block in the round before.
        single = levels.where(F.col("n") <= BLOCK)
        met = spread_join(single, above.withColumnRenamed("path", "upper"), "group")
        if k < len(rounds) - 1:
            met = met.unionByName(levels.where(F.col("n") > BLOCK).join(small(blocks.withColumnRenamed("path", "upper")), ["group", "block"]))
        each = leaves_of(met, "upper", others)
        if not k:
            return each.select("group", "row.*", "path", *others)
        blocks = stage(each.select("group", (F.col("block") * BLOCK + F.col("row.at")).alias("block"), "path", *others), f"{name}-paths{k}")
    raise AssertionError


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest gives with its proof."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def joined(path: Column) -> Column:
    """All sibling digests of a proof, from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame, keep: dict[str, Column] | None = None) -> DataFrame:
    """A row for each document: doc_id, leaf (binary), path (its proof), subroot, root; and ``keep``, columns of documents."""
    fields = {k: F.col(k) for k in FIELDS}
    keep = keep or {}
    leaves = docs.select("doc_id", group_key(F.col("source").cast("string")).alias("group"), F.unhex(leaf(**fields)).alias("digest"), *(c.alias(k) for k, c in keep.items()))
    leaves = stage(leaves, "merkle-leaves")
    kept = ["doc_id", "leaf", *keep]
    places = numbered(leaves, "group", ["doc_id", "digest"], "merkle").withColumn("leaf", F.col("digest"))
    rounds, subroots = roots(places, kept, "merkle")
    subroots = stage(subroots, "merkle-subroots")
    # The sources' roots are leaves of one more tree, of one group.
    sources = numbered(subroots.select(F.lit("").alias("group"), F.col("group").alias("key"), "digest"), "group", ["key"], "merkle-sources").withColumn("subroot", F.col("digest"))
    upper, root = roots(sources, ["key", "subroot"], "merkle-top")
    none = F.array().cast(_PATH)
    tops = proofs(upper, root.select("group", none.alias("path"), F.col("digest").alias("root")), "merkle-top")
    tops = stage(tops.select(F.col("key").alias("group"), "path", "subroot", "root"), "merkle-tops")
    return proofs(rounds, tops, "merkle").drop("group", "at")


def verify(found: DataFrame, changed: Column) -> DataFrame:
    """``found`` (of ``manifest``) with folded_root, from the digest ``changed`` in place of the leaf, and verified."""
    out = found.withColumn("folded_root", fold(changed, F.col("path")))
    return out.withColumn("verified", F.col("folded_root") == F.lower(F.hex("root")))


def digests(docs: DataFrame) -> DataFrame:
    """Every fifth id, by its checksum, is checked with a changed text."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    changed = {k: F.col(k) for k in FIELDS} | {"text": F.translate("text", _UPPER, _LOWER)}
    tampered = F.when(crc % TAMPERED == 0, F.unhex(leaf(**changed)))
    found = manifest(docs.select(*FIELDS), {"tampered": tampered})
    text = lambda c: F.lower(F.hex(c))
    out = verify(found, text(F.coalesce("tampered", "leaf")))
    return out.select("doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"), F.sha2(joined(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified")


def _level_sql(name: str, below: str, group: str) -> str:
    """One level up in SQL: nodes (group, pos, n, digest, members) in runs of 16; a group's only node stays."""
    return f"""{name} AS (
  SELECT {group}, up AS pos, CAST(ceil(max(n) / {FAN}.0) AS BIGINT) AS n, CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM (SELECT *, pos // {FAN} AS up FROM {below}) GROUP BY {group}, up
)"""


def digest_sql(levels: int = 6, source_levels: int = 3) -> str:
    """SQL for up to 16**levels rows of a source and 16**source_levels sources."""
    field = lambda c: f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    hashed = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = f"list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))), lambda a, x: list_reduce(list_prepend(xor(a, x), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda c, i: {shift}))"
    parts = [f"""d AS (
  SELECT doc_id, coalesce('=' || source, '-') AS g, {hashed("text")} AS leaf, CASE WHEN xor({crc}, 4294967295) % {TAMPERED} = 0 THEN {hashed(lowered)} END AS tampered FROM documents
), l0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n, leaf AS digest FROM d)"""]
    parts += [_level_sql(f"l{k + 1}", f"(SELECT g, pos, n, digest FROM l{k})", "g") for k in range(levels)]
    parts.append(f"t0 AS (SELECT 0 AS z, g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, digest FROM l{levels})")
    parts += [_level_sql(f"t{k + 1}", f"(SELECT z, pos, n, digest FROM t{k})", "z") for k in range(source_levels)]
    paths = ["p0 AS (SELECT doc_id, g, leaf, tampered, pos, n, '' AS proof, coalesce(tampered, leaf) AS node FROM l0)"]

    def up(name: str, below: str, level: str, group: str) -> str:
        part = lambda side: f"coalesce((SELECT string_agg(digest, '' ORDER BY s.pos) FROM {level} s WHERE s.{group} = p.{group} AND s.pos // {FAN} = p.pos // {FAN} AND s.pos {side} p.pos), '')"
        return f"""{name} AS (
  SELECT doc_id, g, z, leaf, tampered, CASE WHEN n = 1 THEN pos ELSE pos // {FAN} END AS pos, CAST(ceil(n / {FAN}.0) AS BIGINT) AS n, CASE WHEN n = 1 THEN proof ELSE proof || lefts || rights END AS proof,
    CASE WHEN n = 1 THEN node ELSE sha256(lefts || node || rights) END AS node FROM (SELECT p.*, {part("<")} AS lefts, {part(">")} AS rights FROM {below} p)
)"""

    below = "(SELECT *, 0 AS z FROM p0)"
    for k in range(levels):
        paths.append(up(f"p{k + 1}", below, f"l{k}", "g"))
        below = f"p{k + 1}"
    paths.append(f"q0 AS (SELECT p.doc_id, p.g, p.z, p.leaf, p.tampered, t.pos, t.n, p.proof, p.node FROM {below} p JOIN t0 t ON t.g = p.g)")
    below = "q0"
    for k in range(source_levels):
        paths.append(up(f"q{k + 1}", below, f"t{k}", "z"))
        below = f"q{k + 1}"
    return "WITH " + ", ".join(parts + paths) + f"""
SELECT doc_id, leaf, t0.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.digest AS verified
FROM {below} q JOIN t0 ON t0.g = q.g CROSS JOIN t{source_levels} r"""


DIGEST_SQL = digest_sql()
