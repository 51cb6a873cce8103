"""Tokens that the secret scan has to test, and all of each."""

import numpy as np
import pytest

from ledgerline.llm import secret_scan

ALPHABET = np.array(list(secret_scan.ENCODINGS[-2][1]))


def bins(text):
    return [c["bin"] for c in secret_scan.candidates([text], [[]])[0]]


def test_long_tokens_are_tested_to_their_end():
    rng = np.random.default_rng(20)
    start = "".join(rng.choice(ALPHABET, 4096))
    while not bins(start)[0]:
        start = "".join(rng.choice(ALPHABET, 4096))
    assert bins(start + "ab1" * 1300) == [0]


def test_long_random_tokens_have_even_p():
    rng = np.random.default_rng(21)
    found = [bins("".join(rng.choice(ALPHABET, 4096 * 12 + 100)))[0] for _ in range(30)]
    assert sum(b >= secret_scan.P_BINS // 2 for b in found) >= 9


@pytest.mark.parametrize("symbols", ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])
def test_secrets_of_one_class_are_found(spark, symbols):
    rng = np.random.default_rng(22)
    texts = [f"see {''.join(rng.choice(list(symbols), 30))} there" for _ in range(200)] + ["see " + "01" * 15 + " and " + "ab" * 15 + " there"] * 300
    found = {r.doc_id: r.spans for r in secret_scan.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum("random:4:34" in found[i] for i in range(200)) > 160
    assert not any("random" in found[200 + i] for i in range(300))


@pytest.mark.parametrize("symbols", [ALPHABET, list(secret_scan.ENCODINGS[-1][1])])
def test_secrets_after_paths_are_found(spark, symbols):
    rng = np.random.default_rng(23)
    texts = [f"GET /my-app+x_y{'/' if '-' in symbols else '-'}{''.join(rng.choice(symbols, 60))} end" for _ in range(200)]
    texts = [t for t in texts if set("+/-_") & set(t[-64:-4])]
    found = {r.doc_id: r.spans for r in secret_scan.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum("random:16:76" in found[i] for i in range(len(texts))) > 0.8 * len(texts)


def test_parts_of_a_token_without_alphabet():
    key = "q7" * 12
    assert [(a, b) for a, b, *_ in secret_scan.pieces(f"/my-app/{key}==")] == [(4, 34), (8, 34)]
    assert secret_scan.pieces("a-b/c_d+e" * 4) == []
