"""Substring dedup by suffix automata of reference shards.

A document is streamed through automata of the other documents' text; where its matching statistics reach
``WIDTH`` words that also start in a document with a smaller doc_id, the maximal span goes. The reference is
the corpus itself, so broadcasting automata of all of it would grow with the data and cost documents times
shards. Instead the reference is cut into shards by content, and each passage meets only the shard that can
match it:

1. Every window of ``WIDTH`` words has one anchor, the least hash among its runs of ``ANCHOR`` words; equal
   windows have equal anchors. Each task counts its documents by anchor and group of doc_ids; anchors of one
   document only are forgotten, the others return to the groups that hold them.
2. There, next to its anchors, each text gives for every such anchor the passage of all windows that it
   anchors.
3. A shard is some anchors with all their distinct passages. Its automaton's states carry the least doc_id of
   their occurrences; streaming each passage through it gives the least doc_id of every window.
4. Each document loses the words of its covered windows.

Anchors of more than ``HOT`` documents are dealt by window instead of whole: a window's words go to as many
shards as its places need, the places to one of them each. So a shard holds at most ``SHARD_WORDS`` words plus
the passages of one anchor of at most ``HOT`` documents. Hashes only route: automata compare words.

Cases: null or empty text has no words; texts under ``WIDTH`` words lose nothing; rows with null doc_id are
neither reference nor reduced; rows of one doc_id do not reduce each other; very long texts are hashed in
pieces of ``PIECE`` bytes; an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 13
ANCHOR = 5
#: Words of one automaton, give or take an anchor.
SHARD_WORDS = 20_000
#: Documents that share an anchor beyond which it is dealt by window.
HOT = 1 << 14
#: doc_ids of one group: 2 ** GROUP_BITS.
GROUP_BITS = 12
#: Rows that a task reduces at once; bytes that it hashes at once.
COMBINE_ROWS, PIECE = 2_000_000, 1 << 20

_RNG = np.random.default_rng(13)
_VALUES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64, at least ``n``."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        _POWERS[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))]) for b in (np.uint64(_BASE), inverse)]
    return _POWERS[0], _POWERS[1]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of the texts data[bounds[i]:bounds[i + 1]]."""
    parts, low, n = [], int(bounds[0]), int(bounds[-1])
    while low < n:
        high = min(low + PIECE, n)
        while high < n:  # on to the next space
            gap = np.flatnonzero(_SPACE[data[high : high + 4096]])
            high = min(high + 4096, n) if not len(gap) else high + int(gap[0])
            if len(gap):
                break
        piece = data[low:high]
        inside = ~_SPACE[piece]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cuts = bounds[np.searchsorted(bounds, low, "right") : np.searchsorted(bounds, high)] - low  # texts that start inside
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        power, inverse = _powers(max(PIECE + 4096, len(piece)))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[piece] * power[: len(piece)])])
        h = (total[end] - total[start]) * inverse[start]
        h ^= h >> np.uint64(32)
        parts.append((start + low, end + low, h * np.uint64(0x94D049BB133111EB)))
        low = high
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))


def anchors(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) for each run of windows of one text with one anchor.

    ``h`` and ``text`` give each word's hash and text; windows are numbered by their first word."""
    n = len(h) - WIDTH + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none, none
    g = np.zeros(len(h) - ANCHOR + 1, np.uint64)
    for j in range(ANCHOR):
        g = (g ^ h[j : j + len(g)]) * np.uint64(_BASE)
        g ^= g >> np.uint64(29)
    g = (g * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(16)
    # Least of WIDTH - ANCHOR + 1 runs: by doubling, then two overlapping powers of two.
    span, width = 1, WIDTH - ANCHOR + 1
    while 2 * span <= width:
        g = np.minimum(g[: len(g) - span], g[span:])
        span *= 2
    least = np.minimum(g[:n], g[width - span : width - span + n])
    whole = text[:n] == text[WIDTH - 1 :]
    first = whole.copy()
    first[1:] &= (least[1:] != least[:-1]) | ~whole[:-1] | (text[1:n] != text[: n - 1])
    last = whole.copy()
    last[:-1] &= first[1:] | ~whole[1:]
    at = np.flatnonzero(first)
    return least[at].astype(np.int64), at, np.flatnonzero(last)


#: More than any doc_id.
_NONE = 1 << 63


class SuffixAutomaton:
    """Of several word sequences; each state knows the least id of a sequence in which its words occur."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.low = [-1], [0], [_NONE]

    def add(self, ws: list[bytes], doc: int) -> None:
        nexts, link, size, low = self.next, self.link, self.size, self.low
        last = 0
        for w in ws:
            q = nexts[last].get(w)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._split(last, w, q)
                if doc < low[last]:
                    low[last] = doc
                continue
            new, p = len(size), last
            nexts.append({})
            link.append(0)
            size.append(size[last] + 1)
            low.append(doc)
            while p != -1:
                q = nexts[p].setdefault(w, new)
                if q != new:
                    link[new] = q if size[q] == size[p] + 1 else self._split(p, w, q)
                    break
                p = link[p]
            last = new

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A state for the shorter words of ``q`` that are reached from ``p``."""
        nexts, link = self.next, self.link
        copy = len(self.size)
        nexts.append(dict(nexts[q]))
        link.append(link[q])
        self.size.append(self.size[p] + 1)
        self.low.append(self.low[q])
        link[q] = copy
        while p != -1 and nexts[p].get(w) == q:
            nexts[p][w] = copy
            p = link[p]
        return copy

    def finish(self) -> None:
        """Least ids reach all suffixes, longest states first."""
        low, link = self.low, self.link
        for v in np.argsort(self.size, kind="stable")[:0:-1].tolist():
            if low[v] < low[link[v]]:
                low[link[v]] = low[v]

    def stream(self, ws: list[bytes], width: int) -> list[int | None]:
        """For each window of ``width`` words, the least id with that window, from the matching statistics of ``ws``."""
        nexts, link, size, low = self.next, self.link, self.size, self.low
        v, matched, out = 0, 0, []
        for i, w in enumerate(ws):
            while v and w not in nexts[v]:
                v = link[v]
                matched = size[v]
            if w in nexts[v]:
                v = nexts[v][w]
                matched += 1
            while v and size[link[v]] >= width:
                v = link[v]
                matched = min(matched, size[v])
            if i >= width - 1:
                out.append(low[v] if matched >= width else None)
        return out


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _texts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a column of binary texts without nulls."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def _slices(bounds: np.ndarray):
    """Ranges of texts of about ``PIECE`` bytes together."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(bounds, bounds[i] + PIECE, "right")) - 1))
        yield i, j
        i = j


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with each text compressed by itself, to be shuffled; ``_unpacked`` reverses it."""

    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            texts = [len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in _column(batch, "text").to_pylist()]
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, "text", pa.array(texts, pa.binary()))

    return docs.mapInArrow(run, docs.schema)


def _sizes(column) -> np.ndarray:
    """Bytes of each text before it was packed."""
    return np.array([int.from_bytes(t[:8], "little") for t in column.to_pylist()], np.int64)


def _unpacked(column) -> list[bytes]:
    codec = pa.Codec("zstd")
    return [codec.decompress(t[8:], int.from_bytes(t[:8], "little"), asbytes=True) for t in column.to_pylist()]


def anchor_counts(docs: DataFrame) -> DataFrame:
    """h, group, n: documents of the group with that anchor, once for each task (or flush) that saw some."""

    def run(batches):
        hs, gs, n = [], [], 0
        for batch in batches:
            group = _column(batch, "group").to_numpy()
            data, bounds = _texts(_column(batch, "text"))
            for i, j in _slices(bounds):
                start, _, h = words(data, bounds[i : j + 1])
                text = np.searchsorted(bounds[i : j + 1], start, "right") - 1
                h, first, _ = anchors(h, text)
                h, of = _distinct(h, text[first])
                hs.append(h)
                gs.append(group[i:j][of])
                n += len(h)
            if n >= COMBINE_ROWS:
                yield from _counted(hs, gs)
                hs, gs, n = [], [], 0
        if n:
            yield from _counted(hs, gs)

    return docs.mapInArrow(run, "h long, group long, n int")


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((a, b))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _counted(hs: list[np.ndarray], gs: list[np.ndarray]):
    h, g = np.concatenate(hs), np.concatenate(gs)
    order = np.lexsort((g, h))
    h, g = h[order], g[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
    n = np.diff(np.r_[first, len(h)]).astype(np.int32)
    for i in range(0, len(first), 50_000):
        part = first[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(h[part]), pa.array(g[part]), pa.array(n[i : i + 50_000])], ["h", "group", "n"])


def shared_anchors(docs: DataFrame) -> DataFrame:
    """group, h, copies: the anchors of each group that more than one document has; how many shards hold one of its windows."""

    def run(batches):
        columns = [[], [], []]
        for batch in batches:
            for held, column in zip(columns, batch.columns):
                held.append(column.to_numpy())
        if not columns[0]:
            return
        h, g, n = map(np.concatenate, columns)
        order = np.lexsort((g, h))
        h, g, n = h[order], g[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        documents = np.repeat(np.add.reduceat(n, first), np.diff(np.r_[first, len(h)]))
        keep = np.flatnonzero((documents > 1) & np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
        copies = ((documents[keep] - 1) // HOT + 1).astype(np.int32)
        for i in range(0, len(keep), 50_000):
            part = keep[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(g[part]), pa.array(h[part]), pa.array(copies[i : i + 50_000])], ["group", "h", "copies"])

    return anchor_counts(docs).repartition("h").mapInArrow(run, "group long, h long, copies int")


_PASSAGES = "shard long, copy int, passage binary, doc long, key long, start int"
_NAMES = ["shard", "copy", "passage", "doc", "key", "start"]


def _rows(shard, copy, passage, doc, key, start) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(copy, pa.int32()), pa.array(passage, pa.binary()), pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(start, pa.int32())], _NAMES)


class _Windows:
    """Windows of hot anchors that a task has seen, each with its least doc_id: reference for all copies of its shard."""

    def __init__(self):
        self.low: dict[tuple, int] = {}

    def add(self, shard: int, copies: int, window: bytes, doc: int) -> None:
        at = (shard, copies, window)
        self.low[at] = min(doc, self.low.get(at, doc))

    def flush(self):
        rows = ((shard, copy, window, low) for (shard, copies, window), low in self.low.items() for copy in range(copies))
        while some := list(islice(rows, 20_000)):
            yield _rows(*zip(*some), [None] * len(some), [None] * len(some))
        self.low.clear()


def passages(docs: DataFrame) -> DataFrame:
    """shard, copy, passage (words of all windows with one anchor, joined) and its place: doc, key, start (null: reference only)."""
    none = lambda kind: F.lit(None).cast(kind)
    lists = shared_anchors(docs).select("group", F.lit(0).alias("tag"), "h", "copies", none("long").alias("doc_id"), none("long").alias("key"), none("binary").alias("text"))
    texts = _packed(docs).select("group", F.lit(1).alias("tag"), none("long").alias("h"), none("int").alias("copies"), "doc_id", "key", "text")
    met = lists.unionByName(texts).repartition("group").sortWithinPartitions("group", "tag")

    def run(batches):
        hot, known = _Windows(), _Known()
        for batch in batches:
            tag = _column(batch, "tag").to_numpy()
            group = _column(batch, "group").to_numpy()
            edges = np.flatnonzero(np.r_[True, (tag[1:] != tag[:-1]) | (group[1:] != group[:-1])])
            for a, b in zip(edges.tolist(), np.r_[edges[1:], len(tag)].tolist()):
                part = batch.slice(a, b - a)
                if not tag[a]:
                    known.add(group[a], _column(part, "h").to_numpy(), _column(part, "copies").to_numpy())
                elif known.of(group[a]):
                    yield from _sent(part, known, hot)
                    if len(hot.low) >= COMBINE_ROWS // 20:
                        yield from hot.flush()
        yield from hot.flush()

    return met.mapInArrow(run, _PASSAGES)


class _Known:
    """The shared anchors of the group at hand, which come before its texts."""

    def __init__(self):
        self.group, self.parts, self.h, self.copies = None, [], np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, group, h, copies) -> None:
        if group != self.group:
            self.group, self.parts = group, []
        self.parts.append((h, copies))

    def of(self, group) -> bool:
        if group != self.group:
            return False
        if self.parts:
            h, copies = map(np.concatenate, zip(*self.parts))
            order = np.argsort(h)
            self.h, self.copies, self.parts = h[order], copies[order], []
        return True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``h`` are shared, and in how many copies."""
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = np.flatnonzero(self.h[at] == h)
        return hit, self.copies[at[hit]]


def _sent(part, known: _Known, hot: _Windows):
    """Rows of the passages of some texts of the known group; windows of hot anchors go to ``hot``, too."""
    import xxhash

    doc_ids, keys, packed = _column(part, "doc_id").to_numpy(), _column(part, "key").to_numpy(), _column(part, "text")
    for i, j in _slices(np.r_[0, np.cumsum(_sizes(packed))]):
        texts = _unpacked(packed.slice(i, j - i))
        raw, bounds = b"".join(texts), np.r_[0, np.cumsum([len(t) for t in texts])]
        data = np.frombuffer(raw, np.uint8)
        start, end, h = words(data, bounds)
        text = np.searchsorted(bounds, start, "right") - 1
        h, first, last = anchors(h, text)
        hit, copies = known.find(h)
        if not len(hit):
            continue
        h, first, until = h[hit], first[hit], last[hit] + WIDTH - 1
        opens = np.r_[0, np.flatnonzero(text[1:] != text[:-1]) + 1]
        number = first - opens[np.searchsorted(opens, first, "right") - 1]  # of its first window in its own text
        irregular = np.ones(len(start), np.int64)
        irregular[:-1] = (start[1:] != end[:-1] + 1) | (data[end[:-1]] != 32)
        irregular = np.r_[0, np.cumsum(irregular)]
        plain = irregular[until] == irregular[first]
        passage = [raw[a:b] if clean else b" ".join(raw[a:b].split()) for a, b, clean in zip(start[first].tolist(), end[until].tolist(), plain.tolist())]
        doc, key = doc_ids[i:j][text[first]], keys[i:j][text[first]]
        cold = np.flatnonzero(copies == 1)
        yield _rows(h[cold], np.zeros(len(cold), np.int32), passage if len(cold) == len(h) else [passage[k] for k in cold.tolist()], doc[cold], key[cold], number[cold])
        rows = []
        for k in np.flatnonzero(copies > 1).tolist():
            n, d, ws = int(copies[k]), int(doc[k]), passage[k].split(b" ")
            mine = xxhash.xxh64_intdigest(f"{d}:{key[k]}") % n
            for at in range(len(ws) - WIDTH + 1):
                window = b" ".join(ws[at : at + WIDTH])
                shard = xxhash.xxh64_intdigest(window) >> 1
                rows.append((shard, mine, window, d, int(key[k]), int(number[k]) + at))
                hot.add(shard, n, window, d)
        for at in range(0, len(rows), 20_000):
            yield _rows(*zip(*rows[at : at + 20_000]))


_SPANS = "doc long, key long, a int, b int"


class _Shard:
    """Distinct passages, the least doc_id of each and the places that hold it."""

    def __init__(self):
        self.low: dict[bytes, int] = {}
        self.places: dict[bytes, list] = {}
        self.size = 0

    def add(self, passage: bytes, doc: int, key: int | None, start: int | None) -> None:
        low = self.low.get(passage)
        if low is None:
            self.low[passage], self.places[passage] = doc, []
            self.size += passage.count(b" ") + 1
        elif doc < low:
            self.low[passage] = doc
        if start is not None:
            self.places[passage].append((doc, key, start))

    def spans(self):
        """doc, key, a, b: windows a..b of that text that a smaller doc_id has, too."""
        split = {p: p.split(b" ") for p in self.low}
        automaton = SuffixAutomaton()
        for p, ws in split.items():
            automaton.add(ws, self.low[p])
        automaton.finish()
        out = [[], [], [], []]
        for p, ws in split.items():
            lows = automaton.stream(ws, WIDTH)
            top, bottom, n = max(lows), min(lows), len(lows)
            if not self.places[p]:
                continue
            docs, keys, starts = np.array(self.places[p], np.int64).T
            whole = np.flatnonzero(docs > top)
            for held, column in zip(out, (docs[whole], keys[whole], starts[whole], starts[whole] + n - 1)):
                held.append(column)
            rest = np.flatnonzero((docs > bottom) & (docs <= top))
            if len(rest):
                lows = np.array(lows)
                for doc, key, start in zip(docs[rest].tolist(), keys[rest].tolist(), starts[rest].tolist()):
                    edge = np.flatnonzero(np.diff(np.r_[False, lows < doc, False].astype(np.int8)))
                    k = len(edge) // 2
                    for held, column in zip(out, (np.full(k, doc), np.full(k, key), start + edge[::2], start + edge[1::2] - 1)):
                        held.append(column)
        columns = [np.concatenate([*c, np.zeros(0, np.int64)]) for c in out]
        self.__init__()
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2].astype(np.int32)), pa.array(columns[3].astype(np.int32))], ["doc", "key", "a", "b"])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """doc, key, a, b: windows a..b of that text that also start in a document with a smaller doc_id."""
    dealt = passages(docs).repartition("shard", "copy").sortWithinPartitions("shard", "copy")

    def run(batches):
        at, shard = None, _Shard()
        for batch in batches:
            for *own, passage, doc, key, start in zip(*(_column(batch, c).to_pylist() for c in _NAMES)):
                if own != at:
                    if shard.size >= SHARD_WORDS or (at is not None and own[1] != at[1]):
                        yield from shard.spans()
                    at = own
                shard.add(passage, doc, key, start)
        if shard.size:
            yield from shard.spans()

    return dealt.mapInArrow(run, _SPANS)


def reduced(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words that stay, joined by single spaces."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    docs = docs.withColumn("key", F.xxhash64("text")).withColumn("group", F.shiftright("doc_id", GROUP_BITS))
    spans = repeated_windows(docs.where("doc_id is not null")).select(F.col("doc").alias("doc_id"), "key", F.lit(0).alias("tag"), "a", "b", F.lit(None).cast("binary").alias("text"))
    texts = _packed(docs).select("doc_id", "key", F.lit(1).alias("tag"), F.lit(None).cast("int").alias("a"), F.lit(None).cast("int").alias("b"), "text")
    met = spans.unionByName(texts).repartition("doc_id", "key").sortWithinPartitions("doc_id", "key", "tag")

    def run(batches):
        at, held = None, []
        for batch in batches:
            tags = _column(batch, "tag").to_numpy()
            ids, keys, texts = (_column(batch, c) for c in ("doc_id", "key", "text"))
            a, b = (_column(batch, c).fill_null(0).to_numpy() for c in ("a", "b"))
            done, before = [], 0
            for i in [*np.flatnonzero(tags).tolist(), len(tags)]:
                if i > before:  # spans before row i, of one document or of several without text
                    own = (ids[i - 1].as_py(), keys[i - 1].as_py())
                    held = [*held, (a[before:i], b[before:i])] if own == at else [(a[before:i], b[before:i])]
                    at = own
                if i < len(tags):
                    own = (ids[i].as_py(), keys[i].as_py())
                    done.append((own[0], *_without(_unpacked(texts.slice(i, 1))[0], held if own == at else [])))
                before = i + 1
            if done:
                columns = list(zip(*done))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return met.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]))


def _without(text: bytes, spans: list) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the others joined."""
    ws = text.split()
    edge = np.zeros(len(ws) + 1, np.int64)
    for a, b in spans:
        np.add.at(edge, a, 1)
        np.add.at(edge, np.minimum(len(ws), b + WIDTH), -1)
    gone = edge.cumsum()[: len(ws)] > 0
    n = int(gone.sum())
    return len(ws), n, b" ".join(ws if not n else [ws[i] for i in np.flatnonzero(~gone)])


def digests(docs: DataFrame) -> DataFrame:
    return reduced(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Windows by their words; fit for small tables only.
DIGEST_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT s, min(doc_id) AS low FROM g GROUP BY s HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN m USING (s) WHERE doc_id > low)),
k AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
r AS (SELECT k.doc_id, string_agg(word, ' ' ORDER BY k.p) AS kept, count(*) AS n FROM k LEFT JOIN c ON k.doc_id = c.doc_id AND k.p = c.p WHERE c.p IS NULL GROUP BY k.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""
