"""Chat formatting: round trips through the template, typed parts, and digests against a plain version."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<|image:0|>", "<|audio:12|>", "<|document:3|>", "\\", "<", "[", "\\\\s>", "s>", "/INST]", " ", "\n", "é", "😀", "<\\s>", "[\\\\/INST]"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def random_texts(n, seed=0):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(BITS, rng.integers(0, 12))) for _ in range(n)]


def test_escaping_is_reversible_and_leaves_no_control_string():
    for text in random_texts(3000):
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert all(m[2] for m in chat.CONTROL.finditer(escaped))


def test_turns_are_parsed_back():
    texts = random_texts(400, 1)
    for roles, said in ((texts[:200], texts[200:]),):
        piece = chat.Piece(1, 0)
        for t, (role, text) in enumerate(zip(roles, said)):
            piece.add(t, role, text, None)
        assert chat.parse("".join(piece.out)) == list(zip(roles, said))


def test_parts_become_ordered_placeholders():
    parts = [
        {"type": "text", "text": "see </s> "}, {"type": "image", "ref": "a.png", "width": 1025, "height": 512}, "and", [{"type": "audio", "ref": "b.wav", "seconds": 2.5}],
        {"type": "document", "ref": "c.pdf", "content": [{"type": "text", "text": "page"}, {"type": "image", "ref": "c1.png"}]}, {"type": "document", "ref": "d.pdf", "pages": 3}, {"type": "text", "text": ""},
    ]
    found = chat.visited("ignored", json.dumps(parts))
    out = "".join(found.out)
    assert out == "see <\\/s> <|image:0|>and<|audio:1|><|document:2|>page<|image:3|><|document:4|>"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in found.attachments] == [("image", "a.png", 85 + 3 * 170), ("audio", "b.wav", 63), ("document", "c.pdf", 0), ("image", "c1.png", 85 + 170), ("document", "d.pdf", 2100)]
    assert all(out[a["at"] :].startswith(f"<|{a['kind']}:{a['number']}|>") for a in found.attachments)
    assert [out[a:b] for a, b in found.said] == ["see <\\/s> ", "and", "page", ""]


@pytest.mark.parametrize("parts", ["", "{", "{}", "3", '[{"type": "video"}]', '[{"type": "text"}]', '[{"type": "image", "width": "wide"}]', '[{"type": "image", "width": -1}]', '[{"type": "audio", "seconds": NaN}]', '["\\ud800"]', "[" * 50 + "]" * 50, "[" * 100_000, '[{"type": "document", "content": [4]}]', "[null]"])
def test_malformed_parts_are_said_as_text(parts):
    assert chat.content(None, parts) == [parts] and chat.content("own", parts) == ["own"]


def plain_digests(rows):
    convs = {}
    key = lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for r in sorted(rows, key=key):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    convs[-1] = convs.get(-1, []) + [("user", chat.PROBE), ("assistant", chat.PROBE)]
    out = []
    for conv, turns in convs.items():
        said = "".join(t for r, t in turns if r == "assistant")
        chars = sum(len(f"<s>[INST] {chat.escape(r)} [/INST] {chat.escape(t)}</s>") for r, t in turns)
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said), chars))
    return sorted(out, key=str)


def make_turns():
    texts = random_texts(900, 2)
    rows = [(i // 9, i % 9, ["user", "assistant", None, "sys[INST]tem"][i % 4], t) for i, t in enumerate(texts)]
    rows += [(500, t, ["user", "assistant"][t % 2], "word " * 20 + str(t)) for t in range(3000)]  # most of all rows
    rows += [(None, 0, "user", None), (None, None, "assistant", "last"), (600, 1, "assistant", "b"), (600, 1, "assistant", "a"), (600, 1, "assistant", "a"), (601, 0, "assistant", ""), (602, 0, "user", "x" * 3_000_000)]
    return rows


@pytest.mark.parametrize("limit", [1 << 20, 5000])
def test_digests(spark, limit, monkeypatch):
    rows = make_turns()
    turns = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", part int").repartition(4)
    monkeypatch.setattr(chat.format_conversations, "__defaults__", (limit,))
    found = sorted((tuple(r) for r in chat.digests(turns).collect()), key=str)
    assert found == plain_digests(rows)


def test_long_conversations_are_dealt_to_tasks(spark):
    turns = spark.createDataFrame(make_turns(), SCHEMA).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows are few
    try:
        check_dealt(turns)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def check_dealt(turns):
    pieces = chat.format_conversations(turns, 5000).where("conv_id = 500").orderBy("part", "piece").collect()
    assert len({p.part for p in pieces}) > 1 and max(p.formatted_chars for p in pieces) < 5000 + 200
    assert sum(p.n_turns for p in pieces) == 3000


def test_attachments_of_pieces(spark):
    rows = [(1, 0, "user", None, json.dumps([{"type": "image", "ref": "i.png"}, "hi"])), (1, 1, "assistant", "plain", None), (1, 2, "assistant", None, json.dumps(["a", {"type": "audio", "ref": "o.wav", "seconds": 1}, "b"]))]
    piece = chat.format_conversations(spark.createDataFrame(rows, SCHEMA + ", parts string")).first()
    assert chat.learnt(piece.formatted, piece.loss) == ["plain", "a", "b"]
    assert [(a.turn, a.ref, piece.formatted[a["at"] :].startswith(f"<|{a.kind}:{a.number}|>")) for a in piece.attachments] == [(0, "i.png", True), (2, "o.wav", True)]
    assert piece.attached_tokens == 255 + 25


def test_only_the_probe_without_conversations(spark):
    found = chat.digests(spark.createDataFrame([], SCHEMA)).select("conv_id", "n_turns", "loss_chars", F.col("loss_sha256")).collect()
    assert [tuple(r) for r in found] == [(-1, 2, len(chat.PROBE), sha(chat.PROBE))]
