"""Fill-in-the-middle: texts cut in three at seeded code points and put together again behind sentinels.

Arrow compute functions do the cutting, for a batch of texts at a time. A text's code points are the units of a list
array; flattened with their parents' indices they get ordinals; a unit's role (prefix, middle or suffix) follows from
its ordinal and its text's two cuts; units of one role make lists again, and ``binary_join`` makes texts of these.
Texts are cut into blocks of at most ``BLOCK`` bytes between code points, whose pieces are joined the same way, so
that a batch's arrays of units stay small however long a text is.

The cuts and the form come from a hash of the id alone. ``restore`` gives back a text from its output and form: the
sentinels part the pieces, as no text that holds one of them is cut.

Cases: null or empty text is plain and empty; without doc_id the hash is that of an empty id; repeated rows are
transformed each, alike; texts of any length are cut whole; a cut may leave any piece empty; an empty table
gives an empty result; other columns pass through ``transform`` untouched, and those that it adds get underscores if
their names are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

SEED = 1
#: Fixed values of the query's contract: shares (of 100) of texts that are transformed, and of these with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text that are cut in one go, about; each code point takes some 30 bytes meanwhile.
BLOCK = 1 << 20


def blocks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Texts as blocks of whole code points: each block's text, its first unit's ordinal, and the places of its units' bytes (end included)."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    owner, first, places = [], [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        ordinal = 0
        while a < b:
            end = min(b, a + BLOCK)
            while end < b and data[end] & 0xC0 == 0x80:
                end -= 1
            at = np.flatnonzero((data[a:end] & 0xC0) != 0x80) + a
            owner.append(i)
            first.append(ordinal)
            places.append(np.append(at, end))
            ordinal, a = ordinal + len(at), end
    return np.array(owner, np.int64), np.array(first, np.int64), places


def _lists(values: pa.Array, parents: np.ndarray, n: int) -> pa.Array:
    """Values of ascending parents 0..n-1 as a list for each parent."""
    ends = np.cumsum(np.bincount(parents, minlength=n))
    return pa.LargeListArray.from_arrays(pa.array(np.r_[0, ends], pa.int64()), values)


def cut(texts: pa.Array, low: np.ndarray, high: np.ndarray) -> tuple[list[pa.Array], np.ndarray]:
    """Prefixes (units before ``low``), middles (before ``high``) and suffixes of all texts, and the numbers of units."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    data = texts.cast(pa.large_binary()).buffers()[2]
    owner, first, places = blocks(texts)
    joined: list[list[pa.Array]] = [[], [], []]
    count = np.zeros(len(texts), np.int64)
    i = 0
    while i < len(owner):
        j, size = i + 1, places[i][-1] - places[i][0]
        while j < len(owner) and size + places[j][-1] - places[j][0] <= BLOCK:
            size += places[j][-1] - places[j][0]
            j += 1
        # Blocks lie side by side in the batch's text, so their units do.
        at = np.concatenate([*(p[:-1] for p in places[i:j]), places[j - 1][-1:]])
        sizes = np.array([len(p) - 1 for p in places[i:j]], np.int64)
        units = pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int64()), pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), data]))
        flat, parent = pc.list_flatten(units), pc.list_parent_indices(units).to_numpy()
        ordinal = np.arange(len(flat)) - np.r_[0, np.cumsum(sizes)][parent] + first[i:j][parent]
        of = owner[i:j][parent]
        role = (ordinal >= low[of]).astype(np.int8) + (ordinal >= high[of])
        for r in range(3):
            mine = role == r
            joined[r].append(pc.binary_join(_lists(pc.filter(flat, pa.array(mine)), parent[mine], j - i), pa.scalar("", pa.large_string())))
        np.add.at(count, owner[i:j], sizes)
        i = j
    whole = [pc.binary_join(_lists(pa.concat_arrays(j) if j else pa.array([], pa.large_string()), owner, len(texts)), pa.scalar("", pa.large_string())) for j in joined]
    return whole, count


def units(texts: pa.Array) -> np.ndarray:
    """Code points of each text."""
    return pc.fill_null(pc.utf8_length(texts.cast(pa.large_string())), 0).to_numpy().astype(np.int64)


def rearranged(texts: pa.Array, hashes: np.ndarray, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a batch; ``hashes``: four columns of unsigned 32-bit numbers."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = units(texts)
    a, b = hashes[:, 0] % (n + 1), hashes[:, 1] % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    marked = pc.match_substring_regex(texts, "|".join((PREFIX, SUFFIX, MIDDLE))).to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked | (hashes[:, 2] % 100 >= transformed)
    spm = ~plain & (hashes[:, 3] % 100 < suffix_first)
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    # Plain texts aren't cut: their units would be joined again at once.
    rest = np.flatnonzero(~plain)
    (prefix, middle, suffix), _ = cut(texts.take(pa.array(rest)), low[rest], high[rest])
    own = pa.array(spm[rest])
    mark = lambda text: pa.scalar(text, pa.large_string())
    join = lambda *parts: pc.binary_join_element_wise(*parts, mark(""))
    first = pc.if_else(own, join(mark(SUFFIX), suffix), join(mark(PREFIX), prefix))
    second = pc.if_else(own, join(mark(PREFIX), prefix), join(mark(SUFFIX), suffix))
    changed = join(first, second, mark(MIDDLE), middle)
    place = np.full(len(texts), -1, np.int64)
    place[rest] = np.arange(len(rest))
    output = pc.if_else(pa.array(plain), texts, changed.take(pa.array(place, mask=plain)))
    chars = lambda x: pa.array(x, pa.int64(), mask=plain)
    return [pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), chars(low), chars(high - low), output.cast(pa.string())]


def transform(docs: DataFrame, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of n, form, prefix_chars, middle_chars, output; and that column's name.

    Batches of Arrow hold up to ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows and are cut by blocks within."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    key, name = fresh(docs, "key"), fresh(docs, "fim")
    keyed = docs.withColumn(key, F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4))))
    fields = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType())]
    struct = T.StructType([T.StructField(k, t) for k, t in fields])

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts, hashes = (batch.column(names.index(c)) for c in (text, key))
            found = rearranged(texts, hashes.flatten().to_numpy().reshape(-1, 4), transformed, suffix_first)
            kept = [c for c in names if c != key]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in kept), pa.StructArray.from_arrays(found, [k for k, _ in fields])], [*kept, name])

    text = next(c for c in docs.columns if c.lower() == "text")
    return keyed.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, struct)])), name


def restore(output: Column, form: Column) -> Column:
    """The text that was cut, from its output and form alone."""
    pieces = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm, spm = (F.concat(*(F.get(pieces, i) for i in order)) for order in ((1, 3, 2), (2, 3, 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    out, f = transform(docs.select("doc_id", "text"))
    part = F.col(f)
    sha = lambda c: F.sha2(c, 256)
    return out.select("doc_id", part["n"].alias("n"), part["form"].alias("form"), part["prefix_chars"].alias("prefix_chars"), part["middle_chars"].alias("middle_chars"), sha(part["output"]).alias("output_sha256"), sha(restore(part["output"], part["form"])).alias("restored_sha256"))


DIGEST_SQL = f"""
WITH k AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), h AS (
  SELECT *, {", ".join(f"CAST(('0x' || substr(h, {8 * i + 1}, 8)) AS BIGINT) AS h{i + 1}" for i in range(4))} FROM k
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {TRANSFORMED} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (SELECT *, substr(text, 1, low) AS prefix, substr(text, low + 1, high - low) AS middle, substr(text, high + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle ELSE '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
