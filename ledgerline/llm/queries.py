"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import chat, decontam, fertility, fim, merkle, mixing, pii, quality, secret_scan, simhash, substring, tokens, urls
from .common import read


def queries() -> dict:
    docs = lambda s, d: read(s, d, "documents")
    return {
        "op1_simhash": lambda s, d: simhash.digests(docs(s, d)),
        "op2_pii": lambda s, d: pii.digests(docs(s, d)),
        "op3_fertility": lambda s, d: fertility.digests(docs(s, d)),
        "op4_quality": lambda s, d: quality.digests(docs(s, d), read(s, d, "labels")),
        "op5_substring": lambda s, d: substring.digests(docs(s, d)),
        "op6_tokens": lambda s, d: tokens.digests(docs(s, d)),
        "op7_mixing": lambda s, d: mixing.digests(docs(s, d)),
        "op8_urls": lambda s, d: urls.digests(read(s, d, "pages")),
        "op9_secrets": lambda s, d: secret_scan.digests(docs(s, d)),
        "op10_decontam": lambda s, d: decontam.digests(docs(s, d), read(s, d, "benchmark")),
        "op11_fim": lambda s, d: fim.digests(docs(s, d)),
        "op12_merkle": lambda s, d: merkle.digests(docs(s, d)),
        "op13_chat": lambda s, d: chat.digests(read(s, d, "conversations")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_substring": substring.DIGEST_SQL,
        "op7_mixing": mixing.DIGEST_SQL,
        "op10_decontam": decontam.DIGEST_SQL,
        "op11_fim": fim.DIGEST_SQL,
        "op12_merkle": merkle.DIGEST_SQL,
        "op13_chat": chat.DIGEST_SQL,
    }
