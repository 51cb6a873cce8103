"""Quality rules by tokeniser fertility.

The words of a text, joined by single spaces, are encoded by two public vocabularies: a byte-level
BPE gives characters per token and the entropy of the document's tokens, a BPE with byte fallback gives the
share of tokens that are single bytes. Documents are compared with those of their language (or, where that is
null, script) and of about their length, as entropy grows with the number of tokens: for each language and
power of two of tokens, quantiles over all documents make a band for each measure. Quantiles of few documents
are drawn toward those of the language, and these toward those of all, as if ``PRIOR`` documents said the
latter. Documents outside a band are rejected.

Cases: null or empty text has no words, so it fails the base rule; a language or length with few documents has
nearly the bands of its language or of all; repeated rows are measured each; ties don't matter to quantiles;
words are encoded once each, in blocks of ``Vocabularies.BLOCK``, also those of very long texts; an empty table gives an empty result;
other columns play no part.
"""

from __future__ import annotations

import base64
from array import array
from collections import Counter, defaultdict
from itertools import count, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, small, stage

VOCABULARIES = "/opt/tokenizers"
MEASURES = ("chars_per_token", "byte_share", "entropy")
#: A band reaches this many times the distance between median and outer octile beyond that octile, at least the given width.
REACH = 3.0
LEAST = {"chars_per_token": 0.1, "byte_share": 0.02, "entropy": 0.1}
#: Documents that the quantiles of all weigh in those of a language, or those of a language in those of a length.
PRIOR = 30
_SPACES, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
#: What stands for a space in the pieces of the vocabulary with byte fallback.
_MARK = "\u2581"
#: A word starts with white space (other than the spaces between words), ends with it, or has the mark.
_STARTS, _ENDS, _HAS_MARK = 1, 2, 4


def _join(joins: np.ndarray) -> np.ndarray:
    """Whether each word but the last ends, and the next one starts, with white space."""
    return ((joins[:-1] & _ENDS) > 0) & ((joins[1:] & _STARTS) > 0)


class Vocabularies:
    """Encodes running text: words joined by single spaces, a space before the first.

    No token crosses a space, so each distinct word is encoded once and what it becomes is kept, for about ``KEPT``
    words or ``KEPT_BYTES`` bytes of them. But a space joins other white space on both its sides, and the mark that stands
    for a space; texts with such words side by side, or with that mark, are encoded whole."""

    BLOCK = 4000
    KEPT, KEPT_BYTES = 300_000, 1 << 25

    def __init__(self, path: str = VOCABULARIES):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, (Path(path) / "byte_bpe_50k.tiktoken").read_bytes().splitlines())}
        self.bpe = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[i for t, i in ranks.items() if t.startswith(b" ")]] = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=str(Path(path) / "piece_bpe_32k.model"))
        ids = range(self.pieces.vocab_size())
        self.is_byte = np.array([self.pieces.is_byte(i) for i in ids])
        self.begins = np.array([self.pieces.id_to_piece(i).startswith(_MARK) for i in ids])
        self.forget()

    def forget(self) -> None:
        self.number, self.held = defaultdict(count().__next__), 0
        #: By number of a word: where its tokens end, its pieces, single bytes among these, what of it may join with a space.
        self.tokens, self.ends, self.n_pieces, self.n_bytes, self.joins = array("i"), array("q", [0]), array("q"), array("q"), array("b")

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """A number for each word, equal for equal words; valid until the next call."""
        if len(self.number) >= self.KEPT or self.held >= self.KEPT_BYTES:
            self.forget()
        known = len(self.number)
        found = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        new = list(islice(reversed(self.number), len(self.number) - known))[::-1]
        for i in range(0, len(new), self.BLOCK):
            self._learn(new[i : i + self.BLOCK])
        return found

    def _learn(self, words: list[bytes]) -> None:
        self.held += sum(map(len, words))
        texts = b" ".join(words).decode("utf-8", "replace").split(" ")
        joins = np.array([w[0].isspace() * _STARTS + w[-1].isspace() * _ENDS + (_MARK in w) * _HAS_MARK for w in texts], np.int8)
        self.joins.frombytes(joins.tobytes())
        cuts = [0, *(np.flatnonzero(_join(joins)) + 1).tolist(), len(texts)] if joins.any() else [0, len(texts)]
        for i, j in zip(cuts, cuts[1:]):
            self._encode(["x" if m else w for w, m in zip(texts[i:j], joins[i:j] & _HAS_MARK)] if joins.any() else texts)

    def _encode(self, words: list[str]) -> None:
        text = " ".join(words)
        tokens, pieces = self.bpe.encode_to_numpy(" " + text), np.array(self.pieces.encode(text, num_threads=1))
        at, first = np.flatnonzero(self.opens[tokens]), np.flatnonzero(self.begins[pieces])
        if not len(at) == len(first) == len(words):
            raise ValueError("a token crosses a space")
        self.ends.frombytes((len(self.tokens) + np.append(at[1:], len(tokens))).astype(np.int64).tobytes())
        self.tokens.frombytes(tokens.astype(np.int32).tobytes())
        self.n_pieces.frombytes(np.diff(first, append=len(pieces)).astype(np.int64).tobytes())
        self.n_bytes.frombytes(np.add.reduceat(self.is_byte[pieces], first, dtype=np.int64).tobytes())

    def counts(self, words: list[bytes], numbers: np.ndarray) -> tuple[np.ndarray, int, int]:
        """How often each id of the byte-level BPE that occurs does, by id; tokens under the other vocabulary; single bytes among these.

        ``numbers`` are those of ``words``."""
        if not words:
            return np.zeros(0, np.int64), 0, 0
        joins = np.frombuffer(self.joins, np.int8)[numbers]
        if joins.any() and ((joins & _HAS_MARK).any() or _join(joins).any()):
            return self.whole(words)
        ends = np.frombuffer(self.ends, np.int64)
        lengths = ends[numbers + 1] - ends[numbers]
        past = lengths.cumsum()
        tokens = np.frombuffer(self.tokens, np.int32)[np.repeat(ends[numbers + 1] - past, lengths) + np.arange(past[-1])]
        return np.unique(tokens, return_counts=True)[1], int(np.frombuffer(self.n_pieces, np.int64)[numbers].sum()), int(np.frombuffer(self.n_bytes, np.int64)[numbers].sum())

    def whole(self, words: list[bytes]) -> tuple[np.ndarray, int, int]:
        """``counts`` of running text, in blocks of words."""
        times, n, n_bytes = np.zeros(len(self.opens), np.int64), 0, 0
        for i in range(0, len(words), self.BLOCK):
            text = b" ".join(words[i : i + self.BLOCK]).decode("utf-8", "replace")
            times += np.bincount(self.bpe.encode_to_numpy(" " + text), minlength=len(times))
            ids = self.pieces.encode(text, num_threads=1)
            n += len(ids)
            n_bytes += int(self.is_byte[ids].sum())
        return times[times > 0], n, n_bytes


def repeated_words(ids: np.ndarray, width: int = 5) -> int:
    """Words inside any window of ``width`` that the text has twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    for j in range(width):
        h = h * np.uint64(0xBF58476D1CE4E5B9) + mixed[j : j + n]
    ordered = np.sort(h)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    _, first, inverse, counts = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inverse] > 1)
    same = np.ones(len(at), bool)
    for j in range(width):
        same &= ids[at + j] == ids[first[inverse[at]] + j]
    if not same.all():  # two windows with one hash: count by the windows themselves
        seen: dict = {}
        for i in at:
            seen.setdefault(tuple(ids[i : i + width]), []).append(i)
        at = np.array([i for v in seen.values() if len(v) > 1 for i in v], dtype=np.int64)
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + width, -1)
    return int((covered.cumsum() > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


SCRIPTS = (("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("indic", 0x900, 0xDFF), ("kana", 0x3040, 0x30FF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF))


_ASCII, _NOT_LETTERS = bytes(range(128)), bytes(c for c in range(256) if not chr(c).isalpha() or c >= 128)


def script(text: bytes) -> str:
    """The script of most letters; ``none`` without letters."""
    counts = Counter({"latin": len(text.translate(None, _NOT_LETTERS))})
    for c, n in Counter(text.translate(None, _ASCII).decode("utf-8", "replace")).items():
        if c.isalpha():
            counts[next((name for name, low, high in SCRIPTS if low <= ord(c) <= high), "other")] += n
    top = max(counts, key=lambda k: (counts[k], k))
    return top if counts[top] else "none"


_FIELDS = T.StructType([*(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")), *(T.StructField(n, T.DoubleType()) for n in MEASURES), T.StructField("script", T.StringType())])


def measure(text: bytes | None, vocabulary) -> tuple:
    text = text or b""
    ws = text.split()
    n_chars = len(text.translate(None, _SPACES).decode("utf-8", "replace"))
    ids = vocabulary.numbers(ws)
    times, pieces, single = vocabulary.counts(ws, ids)
    tokens = int(times.sum())
    p = times / max(1, tokens)
    return (
        len(ws), n_chars, len(text) - len(text.translate(None, _SYMBOLS)), duplicate_lines(text), repeated_words(ids), tokens,
        n_chars / tokens if tokens else 0.0, single / pieces if pieces else 0.0, float(-(p * np.log2(p)).sum()) if len(p) else 0.0, script(text),
    )


def measures(docs: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """The columns of ``docs`` and the measures of each text."""

    def make():
        vocabulary = Vocabularies(vocabularies)
        kinds = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.string()]

        def run(texts):
            columns = zip(*(measure(t, vocabulary) for t in texts)) if texts else [()] * len(kinds)
            return [pa.array(c, k) for c, k in zip(columns, kinds)]

        return run

    return annotate(docs, "text", make, _FIELDS)


def bands(seen: DataFrame) -> DataFrame:
    """group, bin, then low and high of each measure, from all documents with columns group, bin and the measures."""

    def quantiles(*by: str, name: str) -> DataFrame:
        q = lambda m: F.percentile_approx(m, F.array(F.lit(0.125), F.lit(0.5), F.lit(0.875)), 10_000)
        return stage(seen.groupBy(*by).agg(F.count("*").alias(f"n_{name}"), *(q(m).alias(f"{m}_{name}") for m in MEASURES)), f"fertility-{name}")

    def drawn(n: str, own, toward):
        return F.zip_with(own, toward, lambda q, p: (F.col(n) * q + PRIOR * p) / (F.col(n) + PRIOR))

    out = small(quantiles("group", name="language")).join(quantiles("group", "bin", name="length"), "group").crossJoin(F.broadcast(quantiles(name="all")))  # one row of all
    columns = []
    for m in MEASURES:
        q = drawn("n_length", F.col(f"{m}_length"), drawn("n_language", F.col(f"{m}_language"), F.col(f"{m}_all")))
        for side, outer, sign in (("low", 0, -1), ("high", 2, 1)):
            reach = F.greatest(F.abs(q[outer] - q[1]) * REACH, F.lit(LEAST[m]))
            columns.append((q[outer] + sign * reach).alias(f"{m}_{side}"))
    return out.select("group", "bin", *columns)


def rules(docs: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """doc_id, the base counts, base_failed, the measures, kept."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    seen = measures(docs.select("doc_id", "text", lang.alias("language")), vocabularies).drop("text")
    group = F.coalesce(F.concat(F.lit("lang:"), "language"), F.concat(F.lit("script:"), "script"))
    seen = stage(seen.withColumn("group", group).withColumn("bin", F.floor(F.log2(F.col("n_tokens") + 1.0)).cast("int")), "fertility")
    out = seen.join(small(stage(bands(seen), "fertility-bands")), ["group", "bin"], "left")
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & inside)


def digests(docs: DataFrame) -> DataFrame:
    return rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *MEASURES)
