"""Quality classifier with hierarchical empirical Bayes over sites.

Two logistic models (good quality, toxic) are fitted to at most ``max_rows`` labelled documents, taken in a
seeded hash order, whole texts of any length. Features are proportions of the text and the presence of selected
words and word beginnings; these are selected from grouped counts over the sample, and the driver, which does
the fitting, gets numbers only: proportions and places of selected features. Every document is scored; the
scores are summed by host and by path below it, between-site variances give prior strengths by moments, and
posterior means shrink paths toward their host and hosts toward the global mean. A document's log-odds move by
its host's evidence against the global mean and its path's (without the document itself) against its host's,
each times the share of the variance of single documents that lies between sites of that level: what the site
says of one document.

Documents have no URL here: ``source`` stands for the host and ``lang`` for the path below it.

Cases: null or empty text scores as a text without words; null host or path are a site of their own;
repeated rows are judged each; labels are read once per (doc_id, values); ties in the hash order are broken by
id, labels and text; without both classes among the labels a model says nothing and rejects nothing; an empty
table gives an empty result; ``keep_good`` judges each row by itself, rows that share an id or have none included,
and passes extra columns through, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, small, stage

TRAIN_ROWS = 3000
SEED = 7
#: A document goes below this probability of good quality, or from that probability of being toxic on.
LEAST_QUALITY, MOST_TOXIC = 0.5, 0.35
MAX_FEATURES = 4000
_STRIP = b".,;:!?\"'()[]#*$%&|"


def tokens(text: bytes) -> set[bytes]:
    """Distinct lower-cased words without outer punctuation, and their first five bytes with a mark."""
    ws = {w.strip(_STRIP) for w in text.lower().split()}
    return ws | {b"^" + w[:5] for w in ws if len(w) > 5}


def proportions(text: bytes) -> list[float]:
    ws = text.split()
    n, size = max(1, len(ws)), max(1, len(text))
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / size
    pairs = Counter(zip(ws, ws[1:]))
    return [
        10 * share(b"#*$%&"), 10 * share(b"|"), 10 * share(b"!"), 5 * share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), 5 * share(b"0123456789"), 10 * share(b"<>{}[]\\"),
        1 - len(set(ws)) / n, sum(c - 1 for c in pairs.values() if c > 1) / n, min(len(text) / n, 20) / 5, math.log1p(len(ws)) / 10, 1.0 if len(ws) < 10 else 0.0,
    ]


HEADS = ("quality", "toxic")
_SAMPLE = T.StructType([T.StructField("tokens", T.ArrayType(T.BinaryType())), T.StructField("dense", T.ArrayType(T.DoubleType()))])


def _make_sample():
    def run(texts):
        return [pa.array([sorted(tokens(t or b"")) for t in texts], pa.list_(pa.binary())), pa.array([proportions(t or b"") for t in texts], pa.list_(pa.float64()))]

    return run


def selected(sample: DataFrame, head: str, n0: int, n1: int) -> list[bytes]:
    """The tokens whose frequency differs most between the classes: by the likelihood ratio of two rates against one."""
    ones, zeros = F.count(F.when(F.col(head) == 1, 1)), F.count(F.when(F.col(head) == 0, 1))
    counts = sample.select(F.explode("tokens").alias("token"), head).groupBy("token").agg(ones.alias("a"), zeros.alias("b")).where("a + b >= 8")
    share = (F.col("a") + F.col("b")) / (n0 + n1)
    part = lambda x, n: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / (share * n))).otherwise(0.0)
    gain = F.round(2 * (part("a", n1) + part("b", n0)), 6)
    return [bytes(r.token) for r in counts.withColumn("gain", gain).where("gain > 16").orderBy(F.desc("gain"), "token").limit(MAX_FEATURES).collect()]


def fit(dense: np.ndarray, places: list[np.ndarray], names: list[bytes], y: np.ndarray, steps: int = 400, ridge: float = 0.3) -> dict:
    """Logistic regression on proportions and on which of the tokens ``names`` (by place) a document has."""
    n0, n1 = float((y == 0).sum()), float(y.sum())
    row, col = np.repeat(np.arange(len(y)), [len(p) for p in places]), np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int64)
    w, d, b = np.zeros(len(names)), np.zeros(dense.shape[1]), np.array([math.log(n1 / n0)])
    # Adam on the mean loss with a ridge: few features, so whole batches.
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, d, np.zeros(1))]
    for k in range(1, steps + 1):
        z = b[0] + dense @ d + np.bincount(row, weights=w[col], minlength=len(y))
        e = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        gradients = (np.bincount(col, weights=e[row], minlength=len(w)) / len(y) + ridge * w / len(y), dense.T @ e / len(y) + 0.1 * ridge * d / len(y), np.array([e.mean()]))
        for x, g, (m, v) in zip((w, d, b), gradients, state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return {"bias": float(b[0]), "dense": d.tolist(), "tokens": dict(zip(names, w.tolist()))}


def log_odds(model: dict | None, text: bytes, found: set[bytes], dense: list[float]) -> float:
    if model is None:
        return 0.0
    weight = model["tokens"].get
    return model["bias"] + sum(a * b for a, b in zip(model["dense"], dense)) + sum(weight(t, 0.0) for t in found)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS, seed: int = SEED) -> dict:
    """Models for ``quality`` and ``toxic``. The bounded sample is drawn from the labels before any text is read."""
    chosen = labels.select("doc_id", *HEADS).where("doc_id is not null").distinct().orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", *HEADS).limit(2 * max_rows)
    # Which rows are taken is settled on narrow rows; whole texts are read for these alone, in the tasks that scan them.
    order = [F.xxhash64(F.lit(seed), "doc_id"), "doc_id", *HEADS, "digest"]
    digest = F.xxhash64("text").alias("digest")
    near = docs.select("doc_id", digest).join(F.broadcast(chosen), "doc_id").orderBy(*order).limit(max_rows)
    near = stage(near.groupBy("doc_id", "digest", *HEADS).agg(F.count("*").alias("rows")), "quality-rows")
    texts = docs.select("doc_id", "text", digest).join(F.broadcast(near.select("doc_id", "digest").distinct()), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
    rows = texts.join(F.broadcast(near), ["doc_id", "digest"]).select("doc_id", *HEADS, "text", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).drop("col")
    sample = stage(annotate(rows, "text", _make_sample, _SAMPLE).drop("text"), "quality-sample")
    models: dict = {}
    for head in HEADS:
        known = sample.where(F.col(head).isin(0, 1))
        classes = {r[0]: r[1] for r in known.groupBy(head).count().collect()}
        if len(classes) < 2:
            models[head] = None
            continue
        names = selected(known, head, classes[0], classes[1])
        table = {t: i for i, t in enumerate(names)}

        def places(batches, table=table):
            for batch in batches:
                columns = {c: batch.column(batch.schema.get_field_index(c)) for c in ("dense", "y", "tokens")}
                found = [[table[t] for t in ts if t in table] for ts in columns["tokens"].to_pylist()]
                yield pa.RecordBatch.from_arrays([columns["y"], columns["dense"], pa.array(found, pa.list_(pa.int32()))], ["y", "dense", "places"])

        rows = known.select(F.col(head).cast("double").alias("y"), "dense", "tokens").mapInArrow(places, "y double, dense array<double>, places array<int>").toArrow()
        models[head] = fit(np.array(rows["dense"].to_pylist()), [np.array(p, np.int64) for p in rows["places"].to_pylist()], names, rows["y"].to_numpy())
    return models


def scores(docs: DataFrame, models: dict) -> DataFrame:
    """doc_id, host, path and the log-odds of both heads."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def make():
        fitted = shared.value

        def run(texts):
            quality, toxic = [], []
            for text in texts:
                text = text or b""
                found, dense = tokens(text), proportions(text)
                quality.append(log_odds(fitted["quality"], text, found, dense))
                toxic.append(log_odds(fitted["toxic"], text, found, dense))
            return [pa.array(quality, pa.float64()), pa.array(toxic, pa.float64())]

        return run

    fields = T.StructType([T.StructField("quality", T.DoubleType()), T.StructField("toxic", T.DoubleType())])
    return annotate(docs, "text", make, fields).drop("text")


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def _sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def strength(sites: DataFrame, parent: str | None) -> tuple[float, float]:
    """(mean, prior strength) for sites with n, s (sum of p), ss (sum of p squared): moments of a one-way layout.

    With ``parent`` the means are those of the parents, in columns parent_n and parent_s."""
    if parent is None:
        total = sites.agg(F.sum("n"), F.sum("s")).first()
        n, s = total[0] or 0, total[1] or 0.0
        center = F.lit(s / n if n else 0.5)
    else:
        center = F.col("parent_s") / F.col("parent_n")
    m = F.col("s") / F.col("n")
    r = sites.agg(F.count("*"), F.sum("n"), F.sum("s"), F.sum(F.col("n") * (m - center) ** 2), F.sum(F.col("ss") - F.col("n") * m * m), F.sum(F.col("n").cast("double") ** 2)).first()
    k, n, s, between, within, squares = (x or 0 for x in r)
    if not n:
        return 0.5, 1.0
    mean = s / n
    noise = within / max(1, n - k)
    spread = max(1e-6, (between - (k - 1) * noise) / max(1e-9, n - squares / n)) if k > 1 else 1e-6
    return mean, min(1e6, max(1.0, noise / spread))


def posteriors(scored: DataFrame, head: str) -> tuple[DataFrame, float, float, float]:
    """Paths with n, s and the shrunk host mean; the global mean; the strengths of the global mean as prior of hosts
    and of the host as prior of its paths: the variance within sites over that between them."""
    p = _sigmoid(F.col(head))
    paths = stage(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("ss")), f"quality-{head}")
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "s", "ss")))
    hosts = stage(hosts, f"quality-{head}-hosts")
    mean, k_host = strength(hosts, None)
    h = hosts.select(F.col("host").alias("parent"), F.col("n").alias("parent_n"), F.col("s").alias("parent_s"), ((F.col("s") + k_host * mean) / (F.col("n") + k_host)).alias("host_mean"))
    joined = stage(paths.join(small(h), F.col("host").eqNullSafe(F.col("parent")), "left").drop("parent"), f"quality-{head}-paths")
    return joined, mean, k_host, strength(joined, "host")[1]


def judged(docs: DataFrame, labels: DataFrame, host: str, path: str, keep: list[Column], **options) -> DataFrame:
    """``keep`` (columns of documents), p_quality, p_toxic (both after the site's evidence), kept."""
    models = train(docs, labels, **options)
    scored = stage(scores(docs.select("text", F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), F.struct(*keep).alias("row")), models), "quality-scores")
    out = scored
    for head in HEADS:
        if models[head] is None:
            out = out.withColumn(f"p_{head}", F.lit(1.0 if head == "quality" else 0.0))
            continue
        sites, mean, k_host, k = posteriors(scored, head)
        sites = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "n", "s", "host_mean")
        out = out.join(small(sites), F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left")
        others = (F.col("s") - _sigmoid(F.col(head)) + k * F.col("host_mean")) / (F.col("n") - 1 + k)
        move = (_logit(F.col("host_mean")) - _logit(F.lit(mean))) / (1 + k_host) + (_logit(others) - _logit(F.col("host_mean"))) / (1 + k)
        out = out.withColumn(f"p_{head}", F.round(_sigmoid(F.col(head) + move), 6)).drop("h", "p", "n", "s", "host_mean")
    return out.select("row", "p_quality", "p_toxic", ((F.col("p_quality") >= LEAST_QUALITY) & (F.col("p_toxic") < MOST_TOXIC)).alias("kept"))


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", **options) -> DataFrame:
    """doc_id, p_quality, p_toxic (both after the site's evidence), kept."""
    return judged(docs, labels, host, path, [F.col("doc_id")], **options).select("row.doc_id", "p_quality", "p_toxic", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns: each row's verdict goes with it."""
    kept = judged(docs, labels, "source", "lang", [F.col(f"`{c}`") for c in docs.columns]).where("kept")
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels)
