"""Each operator against a plain version of its contract, on small tables with every odd case."""

import hashlib
import itertools
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontam, fertility, mixing, pii, quality, secret_scan, simhash, substring, tokens, urls

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


def make_texts():
    rng = np.random.default_rng(1)
    passage = prose(rng, 40)
    long = prose(rng, 6000)
    base = prose(rng, 300)
    near = base.split()
    near[150] = "changed"
    return [
        None, "", " \t\n ", "one", "one", "One two three", prose(rng, 12), prose(rng, 13), passage, f"{prose(rng, 30)} {passage} {prose(rng, 20)}", f"{passage}\u00a0x", passage.replace(" ", "\n", 5), base, " ".join(near), base, long, long + " tail",
        "same same same same same same same same same same same same same same same same", "a b " * 30, "\u00e9\u00e8 \ud55c\uad6d\uc5b4 \U0001f600 " * 20, f"{prose(rng, 5)} {passage[: len(passage) // 2]} {prose(rng, 5)}", "line one\nline one\n\nline two\nline one\n " + prose(rng, 20),
    ]


TEXTS = make_texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, ["a", "B", None, "\u00e9"][i % 4]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3, "doc_id").cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ---- 1


def plain_fingerprint(text):
    import xxhash

    w = WORDS.findall(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w)] if len(w) < 4 else [" ".join(w[i : i + 4]) for i in range(len(w) - 3)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints):
    prints = np.array(prints, np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    label = np.arange(len(ids))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return [min(i for i, other in zip(ids, label) if other == own) for own in label]
        label = new


def test_simhash(spark, docs):
    found = by_id(simhash.digests(docs))
    prints = [plain_fingerprint(t) for t in TEXTS]
    assert [found[i].fingerprint for i in range(len(TEXTS))] == [f"{p:016x}" for p in prints]
    assert [found[i].component_id for i in range(len(TEXTS))] == plain_components(list(range(len(TEXTS))), prints)


@pytest.mark.parametrize("chunk", [8192, 16])
def test_simhash_links_all_near_prints(spark, chunk, monkeypatch):
    """Clusters of prints a few bits apart, in chains, one of them larger than a chunk."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = np.random.default_rng(2)
    prints = list(rng.integers(0, 2**63, 200, dtype=np.uint64))
    for center in prints[:5]:
        at = center
        for _ in range(60):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                at = at ^ (np.uint64(1) << np.uint64(b))
            prints.append(at)
    prints = list(dict.fromkeys(int(p) for p in prints))
    rows = [(i, int(np.uint64(p).view(np.int64))) for i, p in enumerate(prints)]
    distinct = spark.createDataFrame(rows, "first long, fp long")
    roots = {r.x: r.root for r in simhash.components(simhash.links(distinct)).collect()}
    groups: dict = {}
    for i, fp in rows:
        groups.setdefault(roots.get(fp, fp), []).append(i)
    found = {i: min(g) for g in groups.values() for i in g}
    assert [found[i] for i in range(len(rows))] == plain_components(list(range(len(rows))), prints)


def test_bit_sliced_distances():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 130, dtype=np.uint64)
    b = a ^ np.array([sum(1 << int(x) for x in rng.choice(64, k % 12, replace=False)) for k in range(130)], np.uint64)
    for radius in range(8):
        near = simhash.within(simhash.planes(a ^ b), 3, radius)
        bits = np.zeros(130, bool) if near is None else np.unpackbits(near.view(np.uint8), bitorder="little")[:130].astype(bool)
        assert (bits == (np.bitwise_count(a ^ b) <= radius)).all()


@pytest.mark.parametrize("blocks", range(6, 11))
def test_tables_find_all_prints_within_the_radius(blocks):
    """Whatever 4 bits differ, the prints agree on all blocks of some table; keys grow with the number of prints."""
    found = next(t for n in range(64) if (t := simhash.tables(1 << n)) and len(t) == len(list(itertools.combinations(range(blocks), 4))))
    covered = [sum(((1 << w) - 1) << o for o, w in own) for own in found]
    rng = np.random.default_rng(blocks)
    for _ in range(500):
        bits = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not bits & c for c in covered)
    assert all(o + w <= 64 for own in found for o, w in own)


def test_spread_join(spark, monkeypatch):
    """By broadcast or dealt out, a join gives the same rows, hot keys included."""
    from ledgerline.llm import common

    many = spark.createDataFrame([(i % 3 if i % 2 else None, i) for i in range(90)] + [(7, i) for i in range(200)], "k long, v long")
    one = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c"), (9, "d")], "k long, name string")
    want = sorted(many.join(one, "k").select("k", "v", "name").collect())
    assert sorted(common.spread_join(many, one, "k").select("k", "v", "name").collect()) == want
    monkeypatch.setattr(common, "SMALL_ROWS", 1)
    assert sorted(common.spread_join(many, one, "k", hot_rows=10).select("k", "v", "name").collect()) == want


# ---- 2

PII_TEXTS = [
    "mail a@b.c.d@e.fo x%y@q.z.. 1.2.3.4.5.6.7.8 300.1.1.1 \u00e9 4111 1111 1111 1111 and 4111-1111-1111-1112 +1 (743) 555-3824, 12 34 +49 +123-4567890123456 \u00e9\U0001f600 me@x.yz 00255.1.2.003",
    "a@b.c%d@e.f", "@a.b x@y", "4111111111111111 5500005555555559 55000055555555591234 1-2", "1.1.1.1.1.1.1 01.02.03.004 256.1.1.1", "+1234567 +12345678 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "x" * 3000 + "@y.z" + ".a" * 3000, "1" * 5000, "+" + "1 " * 40 + "2", None, "",
    "Dear Mr. John Smith, call me: tel 415-555-1234, ssn 123-45-6789, order 987-65-4321",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_pii(text):
    t = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return [
        [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))],
        [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15],
    ]


def test_pii(spark):
    df = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    found = by_id(pii.digests(df))
    for i, text in enumerate(PII_TEXTS):
        base = plain_pii(text)
        r = found[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(b) for b in base], text
        spans = [f"{k}:{a}:{b}" for k, found_ in zip(pii.BASE_KINDS, base) for a, b in found_]
        assert r.base_sha256 == sha(",".join(spans))
        assert set(spans) <= set(r.spans.split(",")) or not spans
    assert "name:" in found[11].spans and "ssn:" in found[11].spans and "tel:" in found[11].spans
    want = plain_found(PII_TEXTS)
    for i in range(len(PII_TEXTS)):
        more = {x for x in found[i].spans.split(",") if x.split(":")[0] in pii.MORE_KINDS}
        assert more == want[i], i


def plain_found(texts):
    """Spans beyond the base ones, by a plain candidate search, plain votes and the model fitted on their counts."""
    import regex

    seen, counts = [], {}
    for i, text in enumerate(texts):
        t = text or ""
        base = [span for spans in plain_pii(text) for span in spans]
        before = 0
        for m in regex.finditer("|".join(f"(?:{pii.CANDIDATE[k]})" for k in ("ssn", "tel", "iban", "street", "name")), t):
            a, b = m.span()
            left, v = t[max(before, a - pii.CONTEXT) : a], m[0]
            before = b
            if any(s < b and a < e for s, e in base):
                continue
            kind = next((k for k in ("street", "iban", "tel", "ssn") if regex.fullmatch(pii.CANDIDATE[k], v)), "name")
            digits = lambda x: sum(c in "0123456789" for c in x)
            sign = lambda x: 1 if x else -1
            ws = v.split(" ")
            titled = regex.match(rf"(?:{pii.TITLES})\.? ", v)
            capitals = [w for w in ws[1 if titled else 0 :]]
            shape = {
                "ssn": lambda: sign(not (v[:3] in ("000", "666") or v[0] == "9" or v[4:6] == "00" or v[7:] == "0000")), "tel": lambda: sign(regex.match(r"\(?[2-9]\d\d\)?[ .-][2-9]\d\d", v)), "iban": lambda: sign(pii.IBAN_LENGTHS.get(v[:2]) == len(v)), "street": lambda: sign(v[0] != "0"),
                "name": lambda: -1 if any(regex.sub(r".*\P{L}", "", x) == y for x, y in zip(ws, ws[1:])) else int(2 <= len(capitals) <= 3 and all(len(w) >= 3 for w in capitals)),
            }[kind]()
            gazetteer = {"iban": lambda: sign(v[:2] in pii.IBAN_LENGTHS), "name": lambda: sign(titled or ws[0] in pii.GIVEN.split("|")), "street": lambda: int(ws[-1] in ("Street", "Avenue", "Road", "Lane", "Boulevard"))}.get(kind, lambda: 0)()
            context = 1 if regex.search(pii.CUES[kind], left) else -1 if regex.search(pii.AGAINST, left) else 0
            crowd = -1 if (regex.search(r"\p{Lu}\p{Ll}+[ ,]+$", left) if kind == "name" else digits(left) >= 10) else 0
            shapes = (min(len(ws), 3) - 1, 0 if len(v) < 12 else 1 if len(v) < 20 else 2, int(left == "" or bool(regex.search(r"[.!?:\n]\s*$", left))))
            pattern = (pii.MORE_KINDS.index(kind), (shape, gazetteer, context, crowd), shapes)
            counts[pattern] = counts.get(pattern, 0) + 1
            seen.append((i, f"{kind}:{a}:{b}", pattern))
    weights = pii.train(dict(sorted(counts.items())))
    out = [set() for _ in texts]
    for i, name, pattern in seen:
        if sum(w * x for w, x in zip(weights, pii._features(*pattern))) > 0:
            out[i].add(name)
    return out


def test_pii_model_finds_planted_names(spark):
    """Planted people, among capitalised words that are none, by what the labelers agree on; no labelled example is given."""
    rng = np.random.default_rng(14)
    people = ["Mr. John Smith", "Mary Jones", "Dr. Anna Weber", "Carlos Ruiz", "Pierre Martin", "Sophie Bernard", "Mrs. Laura Hill", "Klaus Meyer"]
    others = ["The The The", "General Public License", "Of Of Of", "North Wing", "By To", "Main Menu", "Annual Report"]
    texts, names = [], []
    for i in range(300):
        person = i % 3 == 0
        name = str(rng.choice(people if person else others))
        cue = str(rng.choice(["please contact ", "dear ", "signed ", "and then ", "so said "] if person else ["part ", "the ", "version ", "of ", "under "]))
        texts.append(f"w{i} some words {cue}{name} and more of it.")
        names.append(f"name:{texts[-1].index(name)}:{texts[-1].index(name) + len(name)}" if person else "")
    found = by_id(pii.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    hit = sum(found[i].spans == n for i, n in enumerate(names) if n)
    false = sum(bool(found[i].spans) for i, n in enumerate(names) if not n)
    assert hit >= 95 and false <= 10, (hit, false)
    want = plain_found(texts)
    assert all({x for x in found[i].spans.split(",") if x} == want[i] for i in range(300))


def test_pii_model_learns_unreliable_labelers():
    """Where context always contradicts shape and gazetteer, it loses weight."""
    counts = {(0, (1, 1, -1, 0)): 500, (0, (-1, -1, 1, 0)): 500, (0, (1, 1, 1, 0)): 20}
    posterior, model = pii.em(counts)
    assert posterior[0, (1, 1, -1, 0)] > 0.5 > posterior[0, (-1, -1, 1, 0)]
    assert model["rate"][0, 2, True][1] < model["rate"][0, 0, True][1]
    shaped = {(k, v, (1, 0, 0)): n for (k, v), n in counts.items()}
    assert pii.train({}) and len(pii.train(shaped)) == len(pii._features(0, (0, 0, 0, 0), (0, 0, 0)))
    # A shape that goes with agreeing votes speaks where these are silent.
    silent = {(0, (1, 1, 1, 0), (1, 1, 0)): 500, (0, (-1, -1, -1, 0), (1, 0, 1)): 500, (0, (0, 0, 0, 0), (1, 1, 0)): 5}
    weights = np.array(pii.train(silent))
    assert weights @ pii._features(0, (0, 0, 0, 0), (1, 1, 0)) > weights @ pii._features(0, (0, 0, 0, 0), (1, 0, 1))


# ---- 3


def plain_fertility(text):
    t = text or ""
    w = WORDS.findall(t)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts = {g: grams.count(g) for g in set(grams)} if len(w) < 3000 else {}
    for g in grams if len(w) >= 3000 else ():
        counts[g] = counts.get(g, 0) + 1
    covered = {i + j for i, g in enumerate(grams) if counts[g] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_fertility(spark, docs):
    found = by_id(fertility.digests(docs))
    for i, t in enumerate(TEXTS):
        r = found[i]
        own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert own == plain_fertility(t), i
        assert r.base_failed == (own[0] < 10 or 100 * own[4] > 20 * own[0])
        assert not (r.base_failed and r.kept)


def test_fertility_bands_reject_outliers(spark):
    rng = np.random.default_rng(4)
    plain = [(i, " ".join("".join(chr(97 + x) for x in rng.integers(0, 26, 6)) for _ in range(80)), "en") for i in range(60)]
    odd = [(100, "\u4e2d\u6587" * 3 + " " + " ".join(chr(0x1F600 + int(x)) * 2 for x in rng.integers(0, 60, 80)), "en")]
    kept = {r.doc_id: r.kept for r in fertility.digests(spark.createDataFrame(plain + odd, "doc_id long, text string, lang string")).collect()}
    assert not kept[100] and sum(kept.values()) >= 58


def plain_kept(rows):
    """Which rows' measures lie inside the bands: quantiles of sorted values by length within language, drawn toward the
    language's and all rows', widened on either side. ``rows``: dicts of group, bin, failed and the measures."""

    def quantiles(own, m):
        values = sorted(r[m] for r in own)
        return [values[max(1, math.ceil(q * len(values))) - 1] for q in (0.125, 0.5, 0.875)]

    kept = []
    for r in rows:
        good = not r["failed"]
        language = [x for x in rows if x["group"] == r["group"]]
        length = [x for x in language if x["bin"] == r["bin"]]
        for m in fertility.MEASURES:
            drawn = quantiles(rows, m)
            for own in (language, length):
                drawn = [(len(own) * q + fertility.PRIOR * p) / (len(own) + fertility.PRIOR) for q, p in zip(quantiles(own, m), drawn)]
            low, middle, high = drawn
            reach = lambda outer: max(abs(outer - middle) * fertility.REACH, fertility.LEAST[m])
            good = good and low - reach(low) <= r[m] <= high + reach(high)
        kept.append(good)
    return kept


def test_fertility_kept_against_plain_bands(spark):
    rng = np.random.default_rng(17)
    texts = []
    for i in range(300):
        kind = i % 10
        word = lambda: "".join(chr((0x4E00 if kind == 8 else 97) + int(x)) for x in rng.integers(0, 26, int(rng.integers(2, 9))))
        texts.append(" ".join(word() for _ in range(int(rng.integers(3, 160)))) if kind < 9 else " ".join(["same"] * 40) + " " + "zq" * int(rng.integers(1, 200)))
    docs = spark.createDataFrame([(i, t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in fertility.rules(docs).collect()}
    rows = [{"group": f"lang:{('en', 'de')[i % 3]}" if i % 3 < 2 else f"script:{found[i].script}", "bin": int(math.log2(found[i].n_tokens + 1)), "failed": found[i].base_failed, **{m: found[i][m] for m in fertility.MEASURES}} for i in range(300)]
    want = plain_kept(rows)
    assert [found[i].kept for i in range(300)] == want
    assert any(not k and not r["failed"] for k, r in zip(want, rows)) and sum(want) > 150


def test_fertility_measures():
    v = fertility.Vocabularies()
    m = fertility.measure("na\u00efve \U0001f9ff words  here".encode(), v)
    ids = v.bpe.encode_ordinary(" na\u00efve \U0001f9ff words here")
    assert m[5] == len(ids) and m[6] == pytest.approx(m[1] / len(ids)) and m[7] > 0
    assert fertility.script("\u043f\u0440\u0438\u0432\u0435\u0442 abc".encode()) == "cyrillic" and fertility.script(b"123") == "none"


def running_text(v, words):
    """Ids under both vocabularies of words joined by spaces, encoded as one."""
    text = " ".join(words)
    return sorted(Counter(v.bpe.encode_ordinary(" " + text)).items()), v.pieces.encode(text)


def test_fertility_of_words_is_that_of_running_text():
    """Also where white space or the mark of a space joins the space beside it, and after words are forgotten."""
    v, rng = fertility.Vocabularies(), np.random.default_rng(8)
    v.KEPT = 40
    odd = ["a", "it's", "'s", "\u3000", "\u3000a", "a\u3000", "a\u2581", "\u2581a", "\u2581", "\x1c", "\x85b", "b\xa0", "a\xa0b", "\u0301", "\xb4x", "\u4e2d\u6587", "\U0001f600", "<s>", "12.5", "\x00", "x" * 99]
    for k in range(400):
        words = [odd[i] if i < len(odd) else "".join(chr(97 + x) for x in rng.integers(0, 26, 3)) for i in rng.integers(0, len(odd) if k % 2 else 60, int(rng.integers(1, 12)))]
        if k % 4 == 0:
            words = [w for w in words if not (w[0].isspace() or w[-1].isspace() or "\u2581" in w)]
        raw = [w.encode() for w in words]
        times, n, n_bytes = v.counts(raw, v.numbers(raw))
        ids, pieces = running_text(v, words) if words else ([], [])
        assert (times.tolist(), n, n_bytes) == ([c for _, c in ids], len(pieces), sum(map(v.pieces.is_byte, pieces))), words


def test_fertility_encodes_each_word_once():
    v, seen = fertility.Vocabularies(), []

    class Counted:
        def __init__(self, of):
            self.of = of

        def __getattr__(self, name):
            return getattr(self.of, name)

        def encode_to_numpy(self, text):
            seen.append(len(text))
            return self.of.encode_to_numpy(text)

        def encode(self, text, **more):
            seen.append(len(text))
            return self.of.encode(text, **more)

    v.bpe, v.pieces = Counted(v.bpe), Counted(v.pieces)
    texts = [" ".join(f"word{(i * j) % 50}" for j in range(2000)).encode() for i in range(1, 20)]
    plain = fertility.Vocabularies()
    for t in texts:
        assert fertility.measure(t, v) == fertility.measure(t, plain)
    assert sum(seen) <= 2 * 50 * 8


def test_fertility_encodes_texts_whole_only_where_a_space_joins():
    v = fertility.Vocabularies()
    v.whole = lambda words: pytest.fail("encoded whole")
    words = ["a\xa0", "b", "\u3000c", "d\u2003", "\x85"]
    for own in (words[:4], words[2:3] * 2, words[:1] * 2):
        raw = [w.encode() for w in own]
        times, n, _ = v.counts(raw, v.numbers(raw))
        ids, pieces = running_text(v, own)
        assert (times.tolist(), n) == ([c for _, c in ids], len(pieces))
    raw = [w.encode() for w in words]
    with pytest.raises(pytest.fail.Exception):
        v.counts(raw, v.numbers(raw))


# ---- 4


def test_quality(spark):
    rng = np.random.default_rng(5)
    good = [prose(rng, 60, 2000) for _ in range(150)]
    bad = [" ".join(w + "###" for w in prose(rng, 60, 2000).split()) for _ in range(70)]
    toxic = [prose(rng, 30, 2000) + " vile trash vile scum " + prose(rng, 30, 2000) for _ in range(70)]
    texts = good + bad + toxic
    labels = [(i, int(i < 150 or i >= 220), int(i >= 220)) for i in range(0, 290, 2)]
    df = spark.createDataFrame([(i, t, "en", f"s{i % 5}" if i % 7 else None) for i, t in enumerate(texts)] + [(1000, None, None, None), (1001, "", "en", "s1")], "doc_id long, text string, lang string, source string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r.kept for r in quality.judge(df, lab).collect()}
    held_out = [i for i in range(290) if i % 2]
    right = sum(found[i] == (i < 150) for i in held_out)
    assert right / len(held_out) > 0.97 and len(found) == 292
    kept = {r.doc_id for r in quality.keep_good(df.withColumn("gone", F.lit(2)), lab).collect()}
    assert kept == {i for i, k in found.items() if k}
    # A very long labelled text is in the sample like any other.
    long = spark.createDataFrame([(5000 + 2 * i, ("vile scum " if i % 2 else "fair word ") * 40_000) for i in range(6)], "doc_id long, text string")
    sample = quality.train(df.select("doc_id", "text").unionByName(long), lab.unionByName(spark.createDataFrame([(5000 + 2 * i, 1, i % 2) for i in range(6)], "doc_id long, quality int, toxic int")))
    assert {b"vile", b"scum", b"fair"} & set(sample["toxic"]["tokens"])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(df, none).where("not kept").count() == 0


def plain_posteriors(rows):
    """Log-odds of (host, path, log-odds) after site evidence, in plain Python."""
    p = [1 / (1 + np.exp(-z)) for _, _, z in rows]

    def moments(sites, centers):
        n, s, ss = (np.array([f(v) for v in sites.values()]) for f in (len, sum, lambda v: sum(x * x for x in v)))
        within, between = (ss - s * s / n).sum(), (n * (s / n - np.array([centers[k] for k in sites])) ** 2).sum()
        noise = within / max(1, n.sum() - len(n))
        spread = max(1e-6, (between - (len(n) - 1) * noise) / max(1e-9, n.sum() - (n * n).sum() / n.sum())) if len(n) > 1 else 1e-6
        return min(1e6, max(1.0, noise / spread))

    hosts, paths = {}, {}
    for (h, q, _), x in zip(rows, p):
        hosts.setdefault(h, []).append(x)
        paths.setdefault((h, q), []).append(x)
    mean = sum(p) / len(p)
    k_host = moments(hosts, dict.fromkeys(hosts, mean))
    k = moments(paths, {(h, q): sum(hosts[h]) / len(hosts[h]) for h, q in paths})
    host = {h: (sum(v) + k_host * mean) / (len(v) + k_host) for h, v in hosts.items()}
    logit = lambda x: np.log(x / (1 - x))
    out = []
    for (h, q, z), x in zip(rows, p):
        v = paths[h, q]
        others = (sum(v) - x + k * host[h]) / (len(v) - 1 + k)
        out.append(z + (logit(host[h]) - logit(mean)) / (1 + k_host) + (logit(others) - logit(host[h])) / (1 + k))
    return out


def test_quality_against_plain_posteriors(spark, monkeypatch):
    """Given the classifier's log-odds, each document's probability is that of a plain computation."""
    rng = np.random.default_rng(12)
    rows = [(f"h{i % 7}" if i % 5 else None, f"p{i % 3}", float(rng.normal((i % 7) / 2 - 1, 1))) for i in range(400)]
    scored = spark.createDataFrame([(i, *r, 0.0) for i, r in enumerate(rows)], "doc_id long, source string, lang string, quality double, toxic double").withColumn("text", F.lit("x"))
    monkeypatch.setattr(quality, "train", lambda *a, **k: {"quality": {}, "toxic": None})
    monkeypatch.setattr(quality, "scores", lambda df, models: scored.select(F.struct("doc_id").alias("row"), F.col("source").alias("host"), F.col("lang").alias("path"), "quality", "toxic"))
    found = by_id(quality.judge(scored, None))
    want = [1 / (1 + np.exp(-z)) for z in plain_posteriors(rows)]
    assert [found[i].p_quality for i in range(400)] == pytest.approx(want, abs=2e-6)
    assert all(found[i].kept == (found[i].p_quality >= quality.LEAST_QUALITY) for i in range(400))


def test_sparse_sites_shrink(spark):
    rows = [("h1", "p1", 5.0)] * 400 + [("h2", "p1", -5.0)] * 400 + [("h3", "p1", -5.0)]
    scored = spark.createDataFrame(rows, "host string, path string, quality double")
    sites, mean, k_host, k = quality.posteriors(scored, "quality")
    by = {r.host: r.host_mean for r in sites.collect()}
    assert by["h1"] > 0.9 and by["h2"] < 0.1 and by["h2"] < by["h3"] < mean + 0.05 and k >= 1


# ---- 5


def plain_substring(rows):
    first: dict = {}
    words = {i: WORDS.findall(t or "") for i, t in rows}
    for i in sorted(words):
        for j in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][j : j + 13]), i)
    out = {}
    for i, w in words.items():
        gone = {j + k for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i for k in range(13)}
        out[i] = (len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


@pytest.mark.parametrize("shard,hot,rows", [(20_000, 1 << 14, 2_000_000), (60, 1 << 14, 50), (20_000, 1, 50), (20, 2, 2_000_000)])
def test_substring(spark, docs, shard, hot, rows, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", shard)
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "COMBINE_ROWS", rows)
    found = by_id(substring.digests(docs))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in found.items()} == plain_substring(list(enumerate(TEXTS)))


def test_substring_repeated_ids(spark):
    """Rows of one doc_id don't reduce each other; rows without one are left alone."""
    text = " ".join(f"x{i}" for i in range(30))
    df = spark.createDataFrame([(5, text), (5, text), (5, "pre " + text), (5, None), (None, text), (7, "new " + text)], "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring.digests(df).collect())
    assert rows == [("5", 0, 0), ("5", 30, 0), ("5", 30, 0), ("5", 31, 0), ("7", 31, 30), ("None", 30, 0)]


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 20])
def test_words_and_anchors(piece, monkeypatch):
    """Words by their bounds, in pieces of any size; equal windows of any texts have equal anchors."""
    monkeypatch.setattr(substring, "PIECE", piece)
    texts = [(t or "").encode() for t in TEXTS]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    start, end, h = substring.words(data, bounds)
    assert [data[a:b].tobytes() for a, b in zip(start, end)] == [w for t in texts for w in t.split()]
    of = np.searchsorted(bounds, start, "right") - 1
    seen, windows = {}, 0
    for anchor, a, b in zip(*substring.anchors(h, of)):
        assert of[a] == of[b + substring.WIDTH - 1]
        for i in range(a, b + 1):
            assert seen.setdefault(tuple(h[i : i + substring.WIDTH]), anchor) == anchor
            windows += 1
    assert windows == sum(max(0, len(t.split()) - substring.WIDTH + 1) for t in texts)


def test_suffix_automaton():
    rng = np.random.default_rng(6)
    texts = [[f"{x}".encode() for x in rng.integers(0, 3, 60)] for _ in range(8)]
    a = substring.SuffixAutomaton()
    for d, t in sorted(enumerate(texts), key=lambda x: -x[0]):
        a.add(t, d)
    a.finish()
    for probe in [*texts, [f"{x}".encode() for x in rng.integers(0, 4, 80)]]:
        for width in (1, 4, 7):
            want = [min((d for d, t in enumerate(texts) if any(t[j : j + width] == probe[i : i + width] for j in range(len(t) - width + 1))), default=None) for i in range(len(probe) - width + 1)]
            assert a.stream(probe, width) == want


# ---- 6


def test_tokens_round_trip(spark, docs, tmp_path):
    more = docs.withColumn("slot", F.lit("x")).unionByName(docs.where("doc_id in (8, 15)").withColumn("slot", F.lit("y"))).unionByName(docs.where("doc_id = 15").select(F.lit(None).cast("long").alias("doc_id"), "text", "lang", "source", F.lit("z").alias("slot")))
    found, out = tokens.materialise(more, f"file://{tmp_path}/t", length=64, sequences_per_shard=50)
    rows = sorted(found.collect(), key=lambda r: r.slot)
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n)) and len({r.shard for r in rows}) > 5
    data = tokens.read_slots(out, 0, n)
    t = tokens.Tokenizer()
    coded = lambda x: [*t.bpe.encode_ordinary(x or ""), tokens.END]
    texts = [(r.doc_id, coded(r.text)) for r in more.collect()]
    parts: dict = {}
    for r in rows:
        assert hashlib.sha256(data[r.slot][: r.n_tokens].tobytes()).hexdigest() == r.sha256 and (data[r.slot][r.n_tokens :] == tokens.END).all()
        at = 0
        for p in r.pieces:
            parts.setdefault((p.doc_id, p.start), []).append(data[r.slot][at : at + p.n].tolist())
            at += p.n
        assert at == r.n_tokens
    # Every token of every row is in exactly one place: a document's parts, by id and first token, as often as its rows.
    want: dict = {}
    for doc, ids in texts:
        for start in {s for d, s in parts if d == doc}:
            length = len(parts[doc, start][0])
            want.setdefault((doc, start), []).append(ids[start : start + length])
    assert sum(len(p) for ps in parts.values() for p in ps) == sum(len(ids) for _, ids in texts)
    assert all(sorted(map(tuple, parts[at])) == sorted(tuple(p) for p in want[at] if p) for at in parts if at[0] not in (8, 15, None))
    whole = [p for (d, s), ps in sorted(parts.items(), key=str) if d == 16 for p in ps]
    assert sorted(x for p in whole for x in p) == sorted(dict(texts)[16])
    # Packing leaves at most one padded sequence in each shard; the order is mixed.
    assert sum(r.n_tokens < 64 for r in rows) <= len({r.shard for r in rows})
    order = [p.start for r in rows for p in r.pieces if p.doc_id == 16]
    assert order != sorted(order)
    assert (tokens.read_slots(out, 25, 30) == data[25:55]).all() and tokens.read_slots(out, n, 5).shape == (0, 64)


def test_tokens_do_not_depend_on_splits(spark, docs, tmp_path):
    """Files read in splits of any size and rows in any order give the same shards."""
    docs.repartition(2).write.parquet(str(tmp_path / "docs"))
    made = []
    for k, size in enumerate(("128m", "2k", None)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size or "128m")
        df = spark.read.parquet(str(tmp_path / "docs")) if size else docs.repartition(7)
        found, out = tokens.materialise(df, f"file://{tmp_path}/t{k}", length=64, sequences_per_shard=50)
        made.append((sorted((r.slot, r.shard, r.sha256) for r in found.collect()), tokens.read_slots(out, 0, 10_000).tobytes()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert made[0] == made[1] == made[2]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation(n):
    p = tokens.permuted(np.arange(n), n)
    assert sorted(p) == list(range(n))
    assert n < 100 or (p != tokens.permuted(np.arange(n), n, key=9)).mean() > 0.9


# ---- 7


def plain_mix(rows):
    size = lambda t: len(WORDS.findall(t or ""))
    sources: dict = {}
    for _, t, s in rows:
        sources[s] = sources.get(s, 0) + size(t)
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sources.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(3 * sources[s] for s in capped)
        target = {s: 3 * sources[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        over = {s for s in free if target[s] > 3 * sources[s]}
        if not over:
            return sources, target
        capped |= over


def test_mixing(spark, docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    sources, target = plain_mix(rows)
    found = by_id(mixing.digests(docs))
    taken: dict = {}
    for i, t, s in rows:
        r = found[i]
        assert (r.size, r.source_size) == (len(WORDS.findall(t or "")), sources[s]) and r.target == pytest.approx(target[s]) and r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    largest = max(r.size for r in found.values())
    assert all(abs(taken[s] - target[s]) <= largest for s in taken)
    assert {i: r.taken for i, r in by_id(mixing.digests(docs.repartition(5))).items()} == {i: r.taken for i, r in found.items()}
    copies = {r.doc_id: r["count"] for r in mixing.take(docs.withColumn("mix", F.lit(1))).groupBy("doc_id").count().collect()}
    assert {i: c for i, c in copies.items() if found[i].size} == {i: r.taken // r.size for i, r in found.items() if r.taken}


def test_water_filling_clamps(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(1000, "a"), (10, "b"), (5000, "c"), (0, "d"), (300, None)])]
    found = by_id(mixing.digests(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    _, target = plain_mix(rows)
    assert {i: found[i].target for i in range(5)} == {i: pytest.approx(target[s]) for i, (_, _, s) in enumerate(rows)}
    assert found[1].taken == 30 and found[3].target == 0


@pytest.mark.parametrize("chunk", [mixing.CHUNK, 7])
@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i // 50])
def test_mixing_of_equal_rows(spark, ids, chunk, monkeypatch):
    """Rows that share id and text are taken one by one: each source comes within a document of its target."""
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rows = [(ids(i), "w " * 50, "abc"[i % 3], i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    sources, target = plain_mix([(i, t, s) for i, t, s, _ in rows])
    taken = dict.fromkeys(sources, 0)
    out, m = mixing.mix(df)
    found = out.select("source", "extra", F.col(m)["taken"].alias("taken")).collect()
    for r in found:
        taken[r.source] += r.taken
    assert len(found) == 300 and sum(r.extra for r in found) == 150
    assert all(abs(taken[s] - target[s]) <= 50 for s in taken)
    again = mixing.mix(df.repartition(5))[0].select("source", "extra", F.col(m)["taken"].alias("taken")).collect()
    assert sorted(again) == sorted(found)


# ---- 8


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = lower(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [h + p for h, p, _ in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


URLS = ["http://WWW.Example.com/en/1", "https://a.example.com/en/2?q=1&r=2", "http://example.com/fr/", "http://x.net/es/1", "http://x.net/fr", "http://net/fr/", "ftp://y.org", "com/en/", "http://com", "http://com/", None, "", "http://h.com?x://y/", "http://notexample.com/en/", "a://b://c.com/d#e", "http://x.org/" + "a1" * 3000]


def test_urls(spark):
    extra = [f"http://s{i}.net/{'es' if i % 2 else 'en'}/{i}" for i in range(200)] + [f"http://www.s{i}.com/p{i}?a=b" for i in range(200)]
    rows = list(enumerate(URLS + extra))
    found = by_id(urls.judge(spark.createDataFrame([(i, u, 1) for i, u in rows], "page_id long, url string, score int")), "page_id")
    for i, u in rows:
        host, path, rule = plain_rule(u)
        r = found[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == dict((h + p, v) for h, p, v in urls.RULES)[rule] if rule else r.verdict in ("allow", "block")
    assert not any(found[i].verdict == "block" for i, u in rows if plain_rule(u)[2] is None)  # no held-out evidence in these labels
    labelled = spark.createDataFrame([(f"http://x{i}.org/{'9' * 30 if i % 2 else 'page'}", i % 2) for i in range(300)], "url string, blocked int")
    scored = by_id(urls.judge(spark.createDataFrame([(1, "http://z.org/" + "7" * 30), (2, "http://z.org/page")], "page_id long, url string"), labelled), "page_id")
    assert (scored[1].verdict, scored[2].verdict) == ("block", "allow")


def test_trees_judge_suffixes_they_have_not_seen():
    """Where digits speak, held-out suffixes are told apart; where only suffixes do, they are not, and no share is the row's own."""
    rng = np.random.default_rng(13)
    n = 3000
    suffix, digits, noise = rng.integers(0, 12, n), rng.random(n), rng.random(n)
    fold = rng.integers(0, urls.FOLDS, n)
    for by_digits in (True, False):
        y = ((digits > 0.6) if by_digits else (suffix % 2 == 1)) ^ (rng.random(n) < 0.05)
        held = suffix >= 9
        rates = np.array(urls.out_of_fold([(str(s), int(v), int(k)) for s, v, k in zip(suffix[~held], y[~held], fold[~held])]))
        x = np.stack([digits, noise], axis=1)
        base, trees = urls.fit_trees(np.column_stack([x[~held], rates]), y[~held].astype(float))
        score = np.array([base + sum(urls.predict(t, r) for t in trees) for r in np.column_stack([x[held], np.full(held.sum(), 0.5)])])
        found = urls.auc(score, y[held].astype(int))
        assert found > 0.9 if by_digits else 0.4 < found < 0.6, found
        assert by_digits or urls.auc(rates[fold[~held] > 0], y[~held][fold[~held] > 0].astype(int)) > 0.9
    assert urls.out_of_fold([("a", 1, 1), ("b", 0, 2), ("b", 1, 3), ("b", 0, 0)])[0] == 0.5
    assert urls.auc(np.array([1.0, 1.0, 2.0, 3.0]), np.array([0, 1, 0, 1])) == 0.625


def test_trees_match_their_columns(spark):
    rng = np.random.default_rng(7)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    base, trees = urls.fit_trees(x, y)
    score = np.array([base + sum(urls.predict(t, r) for t in trees) for r in x])
    assert ((score > 0) == y).mean() > 0.95
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:20]], "a double, b double, c double")
    column = F.lit(base)
    for t in trees:
        column = column + urls.tree_column(t, [F.col("a"), F.col("b"), F.col("c")])
    assert [r[0] for r in df.select(column).collect()] == pytest.approx(score[:20].tolist())


# ---- 9

SECRET_TEXTS = [
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and API_KEY:abcdefgh, apikey=short passwd = x', "AKIAABCDEFGHIJKL AKIAABC AKIA" + "Z" * 20, "é😀 secret='Abc/def+123==' PaSsWoRd:12345678", "0123456789abcdef" * 4 + "g", None, "", "Kelvin \u212aey toKen\u017f=abcdefghij", "a" * 5000,
]


def plain_secrets(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets(spark):
    rng = np.random.default_rng(8)
    alphabet = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    keys = ["".join(rng.choice(alphabet, 60)) for _ in range(200)]
    plain = ["item-" + "0" * 25 + f"{i:05d}-aaaaaaaaaaaaaaaaaaaaaaaaaaaa" for i in range(60)]
    texts = SECRET_TEXTS + [f"see {k} there" for k in keys + plain]
    found = by_id(secret_scan.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, t in enumerate(texts):
        base = plain_secrets(t)
        assert [found[i].n_assign, found[i].n_access, found[i].n_hex] == [sum(k == j for _, k, _ in base) for j in range(3)], t
        assert found[i].base_sha256 == sha(",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base))
    n = len(SECRET_TEXTS)
    assert sum("random:4:64" in found[n + i].spans for i in range(200)) > 170
    assert not any("random" in found[n + 200 + i].spans for i in range(60))


def test_secret_spans_against_a_plain_scan(spark):
    """All spans, very long texts included: plain candidates, their p-values counted, and the thresholds of these counts."""
    rng = np.random.default_rng(15)
    alphabet = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"))
    key = lambda n: "".join(rng.choice(alphabet, n))
    texts = [f"say {key(40)} and {'word' * 6} end" for _ in range(120)] + ["long " + " ".join(key(30) for _ in range(3000)) + " token=" + key(20), key(50_000), None, "", "z" * 100_000]
    counts, seen = {}, []
    for i, t in enumerate(texts):
        base = plain_secrets(t)
        for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}={0,2}", t or ""):
            if any(a < m.end() and m.start() < b for a, _, b in base):
                continue
            k = next(k for k, (_, symbols) in enumerate(secret_scan.ENCODINGS) if set(m[0].rstrip("=")) <= set(symbols))
            symbols = secret_scan.ENCODINGS[k][1]
            p = secret_scan.randomness(np.array([[symbols.index(c) for c in m[0].rstrip("=")]]), len(symbols), np.array([(zlib.crc32(m[0].encode()) + 0.5) / 2**32]))[0]
            group = (k * 8 + secret_scan.band(len(m[0])), min(secret_scan.P_BINS - 1, int(p * secret_scan.P_BINS)))
            counts[group] = counts.get(group, 0) + 1
            seen.append((i, m.start(), m.end(), *group))
    least = secret_scan.thresholds(counts)
    want = [sorted([(a, k, b) for a, k, b in plain_secrets(t)] + [(a, 3, b) for j, a, b, g, p in seen if j == i and p >= least.get(g, 99)]) for i, t in enumerate(texts)]
    found = by_id(secret_scan.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [found[i].spans for i in range(len(texts))] == [",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in w) for w in want]
    assert sum(len(w) for w in want) > 2500 and not want[-1]


@pytest.mark.parametrize("size,n", [(10, 20), (16, 31), (26, 24), (36, 48), (62, 48), (64, 60), (64, 170), (64, 330), (26, 400)])
def test_random_p_values_are_even(size, n):
    rng = np.random.default_rng(9)
    p = secret_scan.randomness(rng.integers(0, size, (6000, n)), size, rng.random(6000))
    assert 0.47 < np.mean(p > 0.5) < 0.53
    assert np.abs(np.histogram(p, secret_scan.P_BINS // 5, (0, 1))[0] / 6000 - 0.1).max() < 0.03


def test_thresholds():
    assert secret_scan.thresholds({(0, 0): 1000}) == {}
    assert secret_scan.thresholds({(0, b): 10_000 for b in range(50)})[0] == 0


@pytest.mark.parametrize("ordinary", [0.02, 0.2, 0.5, 0.8, 0.95])
def test_share_of_false_finds(ordinary):
    """Random tokens among ordinary ones of small p: of what passes, at most the rate is ordinary, and most random tokens pass."""
    rng = np.random.default_rng(int(ordinary * 100))
    n = 40_000
    false = rng.random(n) < ordinary
    p = np.where(false, rng.beta(0.2, 12, n), secret_scan.randomness(rng.integers(0, 62, (n, 40)), 62, rng.random(n)))
    bins = np.minimum((p * secret_scan.P_BINS).astype(int), secret_scan.P_BINS - 1)
    least = secret_scan.thresholds({(0, int(b)): int(c) for b, c in zip(*np.unique(bins, return_counts=True))})[0]
    passed = bins >= least
    assert false[passed].mean() <= secret_scan.RATE and (passed & ~false).sum() > 0.6 * (~false).sum()


def test_tests_against_plain_sums():
    """The battery, all tokens at once, against one token's tests in plain sums."""
    rng = np.random.default_rng(10)
    for size, n in ((16, 33), (64, 25), (26, 200)):
        tokens_ = rng.integers(0, size, (20, n))
        for places, found in zip(tokens_.tolist(), secret_scan.battery(tokens_, size)):
            classes = max(2, min(size, n // 5))
            of = [x * classes // size for x in range(size)]
            share = [of.count(c) * n / size for c in range(classes)]
            chi = sum((sum(of[x] == c for x in places) - share[c]) ** 2 / share[c] for c in range(classes))
            high = [2 * x >= size for x in places]
            a = sum(high)
            runs, mean = 1 + sum(x != y for x, y in zip(high, high[1:])), 2 * a * (n - a) / n + 1
            m = sum(places) / n
            serial = sum((x - m) * (y - m) for x, y in zip(places, places[1:])) / sum((x - m) ** 2 for x in places)
            v, k = 2 / (9 * (classes - 1)), classes - 1
            want = [math.erfc(((chi / k) ** (1 / 3) - (1 - v)) / math.sqrt(2 * v)) / 2, math.erfc(abs((runs - mean) / math.sqrt((mean - 1) * (mean - 2) / (n - 1))) / 2**0.5), math.erfc(abs((serial + 1 / n) * n**0.5) / 2**0.5)]
            if n < 5 * size:
                pairs, rate = sum(x == y for i, x in enumerate(places) for y in places[:i]), n * (n - 1) / 2 / size
                want.append(1 - sum(math.exp(-rate) * rate**i / math.factorial(i) for i in range(pairs)))
            assert found == pytest.approx(min(want), abs=1e-9)


def test_many_spans_and_tokens_take_linear_time():
    text = " ".join(f"token=abcdefgh{i:08d} AKIA{i:016d} {'q7' * 12}" for i in range(40_000))
    began = time.time()
    spans = secret_scan.base_spans(text)
    assert len(spans) == 80_000 and len(secret_scan.candidates([text], [spans])[0]) == 40_000
    assert time.time() - began < 20


# ---- 10


def plain_decontam(text, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w = pattern.findall(lower(text))
    hit, found = set(), set()
    for item, t in items:
        v = pattern.findall(lower(t))
        m = min(10, len(v))
        if not m:
            continue
        grams = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)}
        for i in range(len(w) - m + 1):
            if tuple(w[i : i + m]) in grams:
                hit |= set(range(i, i + m))
                found |= {str(item)} - {"None"}
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


@pytest.mark.parametrize("limit", [1 << 20, 40, 12])
def test_decontam(spark, docs, limit):
    passage = TEXTS[8].split()
    items = [(1, " ".join(passage[:25])), (12, " ".join(passage[10:22]).upper()), (3, "same Same, same"), (4, "a-b"), (5, "!!"), (6, None), (None, "one"), (None, " ".join(passage[5:17])), (7, "one"), (7, "same text again"), (7, "tail"), (100, "\u00e9\u00e8"), (9, " ".join(passage[30:39]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out, hit = decontam.annotate_hits(docs.select("doc_id", "text"), bench, max_words=limit)
    h = F.col(hit)
    found = {r.doc_id: (r.n, r.k, len(r.items), decontam.items_digest(r.items), r.k > 0) for r in out.select("doc_id", h["n_words"].alias("n"), h["n_hit"].alias("k"), h["items"].alias("items")).collect()}
    for i, t in enumerate(TEXTS):
        assert found[i] == plain_decontam(t, items), i
    clean = {r.doc_id for r in decontam.remove_contaminated(docs.withColumn("hit", F.lit(0)), bench).collect()}
    assert clean == {i for i, f in found.items() if not f[4]}


def test_wu_manber_against_scan():
    rng = np.random.default_rng(10)
    ws = [f"{x}".encode() for x in rng.integers(0, 4, 400)]
    for m in (1, 2, 3, 6):
        text = [f"{x}".encode() for x in rng.integers(0, 4, 40)]
        starts = list(range(0, 41 - m, 3))
        found = sorted(decontam.WuManber(text, starts, m).find(ws))
        equal = [(i, [p for p in starts if text[p : p + m] == ws[i : i + m]]) for i in range(len(ws) - m + 1)]
        assert found == [(i, places) for i, places in equal if places]


# ---- empty tables


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string")
    for df in (simhash.digests(empty), pii.digests(empty), fertility.digests(empty), quality.digests(empty, labels), substring.digests(empty), tokens.digests(empty), mixing.digests(empty), urls.digests(pages), secret_scan.digests(empty), decontam.digests(empty, bench)):
        assert df.count() == 0
