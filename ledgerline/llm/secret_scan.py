"""Secret scan: three fixed patterns, and random-looking strings found by a battery of randomness tests.

Tokens of 20 and more characters, of digits or letters alone too, get the narrowest encoding whose alphabet
holds them. A token that none holds (one of + and / beside one of - and _) is split at + and / and, once more,
at - and _, and each part of 20 and more characters is tested; parts of the two splits may overlap, and so
may the spans found. Tests ask whether such a token could be drawn uniformly from that alphabet: chi-squared over
equal classes of symbols and, for tokens too short to fill all classes, over single symbols (by their equal pairs,
which the statistic counts); runs above and below the middle of the alphabet; serial correlation at lag one. Each
is over all of the token. The smallest of their p-values has no uniform distribution (tests depend on each other, and
on few symbols they take few values), so a token's p is its rank among ``NULL_TOKENS`` seeded tokens that were drawn
uniformly from the same alphabet at the same length (from 160 symbols on, at the next lower length of a grid); ties
are broken by a hash of the token. So random tokens have uniform p, ordinary ones small p. Over all documents, by
encoding and length band, the number of random tokens is estimated from p > 1/2, somewhat low, and the least
threshold is taken at which the expected share of ordinary tokens among those above it stays under ``rate``.

Cases: null or empty text has no spans; every repeated row is scanned; tokens of one length band that are
all ordinary get no threshold and no span; very long texts and tokens are tested whole, in time that grows with their
length; tokens with equal tests get their ranks by hash, equal tokens equal ones; an empty table gives an empty result;
other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Bounded, annotate, stage

KINDS = ("assign", "access", "hex", "random")
#: Fixed values of the query's contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: What the randomness tests look at.
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Parts of tokens that fit no alphabet.
PARTS = (re.compile(r"[A-Za-z0-9_-]{20,}={0,2}"), re.compile(r"[A-Za-z0-9+/]{20,}={0,2}"))

ENCODINGS = (
    ("digits", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("UPPER", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_INDEX = tuple((name, {c: i for i, c in enumerate(alphabet)}) for name, alphabet in ENCODINGS)
#: p-values are counted in this many equal bins.
P_BINS = 50
#: Uniform tokens that give the null distribution of an encoding and length: so many, fewer of long ones, but no fewer than a quarter.
NULL_TOKENS = 8000
NULL_SEED = 90
RATE = 0.05
#: The number of random tokens is estimated a standard error low, but not under this share of the estimate.
MOST_BELOW = 0.97


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted; a match that fails its length is dropped."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def encoding(token: str) -> tuple[int, list[int]] | None:
    """The first encoding whose alphabet has all characters, and their places in it."""
    body = token.rstrip("=")
    for k, (_, index) in enumerate(_INDEX):
        places = [index.get(c, -1) for c in body]
        if -1 not in places:
            return k, places
    return None


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erfc, x.tolist()), float, len(x))


def normal_tail(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(z) / math.sqrt(2))


def chi_squared_tail(x: np.ndarray, df: int) -> np.ndarray:
    """Upper tail by the Wilson-Hilferty cube root."""
    v = 2 / (9 * df)
    return 0.5 * _erfc((np.cbrt(x / df) - (1 - v)) / math.sqrt(2 * v))


def pairs_tail(pairs: np.ndarray, mean: float) -> np.ndarray:
    """Probability of as many equal pairs of symbols or more: nearly Poisson while pairs are few for each symbol."""
    most = int(pairs.max(initial=0))
    terms = np.exp(-mean + np.arange(most) * math.log(mean) - np.array([math.lgamma(i + 1) for i in range(most)])) if most else np.zeros(0)
    return np.maximum(0.0, 1 - np.r_[0.0, np.cumsum(terms)])[pairs]


def battery(places: np.ndarray, size: int) -> np.ndarray:
    """Smallest p-value of uniformity, runs, serial correlation and, in short tokens, equal pairs; a row for each token of one length."""
    m, n = places.shape
    row = np.arange(m)[:, None]

    def counted(values, k):
        return np.bincount((row * k + values).ravel(), minlength=m * k).reshape(m, k)

    classes = max(2, min(size, n // 5))
    own = np.arange(size) * classes // size
    share = np.bincount(own, minlength=classes) * n / size
    found = [chi_squared_tail(((counted(own[places], classes) - share) ** 2 / share).sum(axis=1), classes - 1)]
    high = places * 2 >= size
    a = high.sum(axis=1)
    b = n - a
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 2 * a * b / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    found.append(np.where(spread > 0, normal_tail((runs - mean) / np.sqrt(np.where(spread > 0, spread, 1))), 1.0))
    centred = places - places.mean(axis=1, keepdims=True)
    var = (centred**2).sum(axis=1)
    serial = np.where(var > 0, (centred[:, 1:] * centred[:, :-1]).sum(axis=1) / np.where(var > 0, var, 1), 1.0)
    found.append(normal_tail((serial + 1 / n) * math.sqrt(n)))
    if n < 5 * size:
        times = counted(places, size)
        found.append(pairs_tail((times * (times - 1) // 2).sum(axis=1), n * (n - 1) / 2 / size))
    return np.where((a == 0) | (b == 0), 0.0, np.min(found, axis=0))


def null_length(n: int, size: int) -> int:
    """Length at which the null distribution for ``n`` is drawn: the same tests, about the same shape."""
    grid = [160, 226, 320, 452, 640, 1280, 5120, 5 * size]
    return n if n < 160 and n != 5 * size else max(x for x in grid if x <= n)


def null_distribution(of: tuple[int, int]) -> np.ndarray:
    """Sorted smallest p-values of uniform tokens; ``of``: symbols and length."""
    size, n = of
    rng = np.random.default_rng((NULL_SEED, size, n))
    step, total = max(1, (1 << 20) // n), min(NULL_TOKENS, max(NULL_TOKENS // 4, NULL_TOKENS * 200 // n))
    return np.sort(np.concatenate([battery(rng.integers(0, size, (min(step, total - i), n)), size) for i in range(0, total, step)]))


_NULLS = Bounded(null_distribution, 1000)


def randomness(places: np.ndarray, size: int, ties: np.ndarray) -> np.ndarray:
    """p of each row of ``places`` (tokens of one length): uniform for tokens drawn uniformly. ``ties``: numbers in 0..1 that part equal ranks."""
    null = _NULLS[size, null_length(places.shape[1], size)]
    found = battery(places, size)
    low, high = np.searchsorted(null, found, "left"), np.searchsorted(null, found, "right")
    return (low + ties * (high - low + 1)) / (len(null) + 1)


def band(n: int) -> int:
    """Length band: 20-27, 28-39, 40-63, 64-127, 128 and more."""
    return sum(n >= x for x in (28, 40, 64, 128))


def pieces(token: str) -> list[tuple[int, int, int, list[int]]]:
    """What is tested of a token: start, end, encoding and places; its parts if no alphabet holds all of it."""
    found = encoding(token)
    if found is not None:
        return [(0, len(token), *found)]
    spans = sorted({m.span() for pattern in PARTS for m in pattern.finditer(token)})
    return [(a, b, *encoding(token[a:b])) for a, b in spans]


def tokens(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, list[int], float]]:
    """Tokens outside the base spans, which are sorted by start: start, end, encoding, places, and what parts ties."""
    starts, ends = [s for s, _, _ in taken], list(accumulate((e for _, _, e in taken), max))
    out = []
    for m in TOKEN.finditer(text):
        for a, b, k, places in pieces(m[0]):
            start, end = m.start() + a, m.start() + b
            before = bisect_left(starts, end)  # of the spans that start before its end, one ends after its start
            if not before or ends[before - 1] <= start:
                out.append((start, end, k, places, (zlib.crc32(text[start:end].encode()) + 0.5) / 2**32))
    return out


def candidates(texts: list[str], taken: list[list[tuple[int, int, int]]]) -> list[list[dict]]:
    """Of each text its tokens: start, end, group (encoding and band), bin of p. Tokens of one kind and length are tested together."""
    out: list[list[dict]] = []
    alike: dict[tuple[int, int], list[tuple[dict, list[int], float]]] = {}
    for text, spans in zip(texts, taken):
        own = []
        for start, end, k, places, tie in tokens(text, spans):
            own.append({"start": start, "end": end, "group": k * 8 + band(end - start), "bin": 0})
            alike.setdefault((k, len(places)), []).append((own[-1], places, tie))
        out.append(own)
    for (k, n), found in alike.items():
        step = max(1, (1 << 20) // n)
        for i in range(0, len(found), step):
            rows, places, ties = zip(*found[i : i + step])
            for row, p in zip(rows, randomness(np.array(places, np.int64), len(ENCODINGS[k][1]), np.array(ties)).tolist()):
                row["bin"] = min(P_BINS - 1, int(p * P_BINS))
    return out


_CAND = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("group", T.IntegerType()), T.StructField("bin", T.IntegerType())]))
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_FIELDS = T.StructType([T.StructField("base", _SPAN), T.StructField("base_sha256", T.StringType()), T.StructField("found", _CAND)])


def _make():
    span = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")]))
    cand = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "end", "group", "bin")]))

    def run(texts):
        texts = [t or "" for t in texts]
        spans = [base_spans(t) for t in texts]
        base = [[{"start": s, "kind": k, "end": e} for s, k, e in own] for own in spans]
        sha = [hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in own).encode()).hexdigest() for own in spans]
        return [pa.array(base, span), pa.array(sha, pa.string()), pa.array(candidates(texts, spans), cand)]

    return run


def thresholds(counts: dict[tuple[int, int], int], rate: float = RATE) -> dict[int, int]:
    """From counts by (group, bin): the least bin from which on tokens of the group are random.

    Storey's estimate: tokens with p > 1/2 are random, and random p is uniform. Of the tokens in bin b or
    above, those beyond the expected number of random ones are ordinary; their share must stay under ``rate``. The
    estimate is taken low, as ``MOST_BELOW`` says; above the middle, where it is made, no token counts as ordinary."""
    out = {}
    for group in {g for g, _ in counts}:
        row = [counts.get((group, b), 0) for b in range(P_BINS)]
        upper = sum(row[P_BINS // 2 :])
        each = max(upper - math.sqrt(upper), MOST_BELOW * upper) / (P_BINS - P_BINS // 2)
        for b in range(P_BINS):
            passed = sum(row[b:])
            if passed and (b >= P_BINS // 2 or passed - each * (P_BINS - b) <= rate * passed):
                out[group] = b
                break
    return out


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, spans: array of (start, kind, end), kind an index into KINDS; base, base_sha256."""
    seen = stage(annotate(docs.select("doc_id", "text"), "text", _make, _FIELDS, binary=False).drop("text"), "secrets")
    rows = seen.select(F.explode("found").alias("f")).groupBy("f.group", "f.bin").count().collect()  # at most encodings * bands * bins rows
    least = thresholds({(r["group"], r["bin"]): r["count"] for r in rows}, rate)
    limit = F.lit(P_BINS)
    passed = lambda c: F.coalesce(F.element_at(table, c["group"]), limit) <= c["bin"]
    table = F.create_map(*(F.lit(x) for g, b in sorted(least.items()) for x in (g, b))) if least else F.create_map(F.lit(-1), F.lit(P_BINS))
    extra = F.transform(F.filter("found", passed), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return seen.select("doc_id", "base", "base_sha256", F.array_sort(F.concat("base", extra)).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    out = scan(docs)
    name = lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), "base_sha256", F.concat_ws(",", F.transform("spans", name)).alias("spans"))
