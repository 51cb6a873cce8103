"""Archives that arrive in any order, some of them while the stream breaks off; and the command line."""

import json
from collections import Counter

import pytest

from ledgerline import __main__ as command
from ledgerline.plans import conformance, parts
from ledgerline.streaming import archives as stream

from .test_conformance import ALIASES, LOAN_HEADER, LOAN_ROW, SECURITY_HEADER, SECURITY_ROW, archive, changed, contract, load

LOANS = ["GLOAN01", "GLOAN02", "GLOAN03", "GLOAN04"]


def make(folder):
    """Two months; the second month's securities and one rejected file are there, too."""
    folder.mkdir()
    later = dict(c2="022026")
    archive(folder, "fu260107", [LOAN_ROW, changed(LOAN_ROW, c0="GLOAN02", c3=" "), changed(LOAN_ROW, c0="GLOAN03", c3="GONE"), changed(LOAN_ROW, c0="GLOAN04", c1="D"), changed(LOAN_ROW, c0="GLOAN05", c3="GSEC09")], LOAN_HEADER)
    archive(folder, "fd260107", [SECURITY_ROW, changed(SECURITY_ROW, c1="GSEC02", c3="", c7="-.5")], SECURITY_HEADER)
    archive(folder, "fd260207", [changed(SECURITY_ROW, c1="GSEC09", **later), changed(SECURITY_ROW, **later)], SECURITY_HEADER)
    archive(folder, "fu260207", [LOAN_ROW, changed(LOAN_ROW, c0="GLOAN05", c3="GSEC09"), changed(LOAN_ROW, c0="GLOAN06", c4="malformed")], LOAN_HEADER)


def rows(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


class Killed(Exception):
    pass


@pytest.mark.parametrize("steps", [["staged", "repaired"]])
def test_a_stream_ends_as_one_batch(spark, tmp_path, steps):
    """One archive at a time, with the stream killed at some steps and started again: the same as all archives at once."""
    folder, root = tmp_path / "in", str(tmp_path / "out")
    make(folder)
    left = list(steps)

    def after(step):
        if left and step == left[0]:
            left.pop(0)
            raise Killed(step)

    for _ in range(len(steps) + 1):
        query = stream.conformed_stream(spark, str(folder), contract(), ALIASES, root, str(tmp_path / "checkpoint"), files_per_batch=1, after=after)
        try:
            query.awaitTermination(300)
        except Exception as e:
            assert "Killed" in str(e)
    assert not left
    want = load(spark, folder, tmp_path / "work")
    facts = ("report_period", "loan_id", "security_id", "source_file")
    assert rows(parts.Parts(spark, f"{root}/joined/loans").read(), *facts, "join_reason") == rows(want.loans, *facts, "join_reason")
    assert rows(parts.Parts(spark, f"{root}/joined/join_counts").read(), "report_period", "join_reason", "row_count") == rows(want.loans.groupBy("report_period", "join_reason").count(), "report_period", "join_reason", "count")
    manifest = ("source_file", "input_count", "accepted_count", "rejected_count", "quality_status")
    assert rows(conformance.published(spark, root, "manifest"), *manifest) == rows(want.manifest, *manifest)
    assert ("2026-01", "GLOAN05", "GSEC09", "fu260107.zip", "late") in rows(want.loans, *facts, "join_reason")


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    """Conform, then metrics: a second run reads nothing, one after a change reads that file."""
    folder = tmp_path / "in"
    make(folder)
    (tmp_path / "contract.json").write_text(json.dumps(contract()))
    (tmp_path / "aliases.json").write_text(json.dumps(ALIASES))
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    at = lambda n: str(tmp_path / n)

    def run(*argv):
        assert command.main(list(argv)) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    conform = ("conform", str(folder), at("contract.json"), at("aliases.json"), at("work"), at("published"))
    metrics = ("metrics", at("published"), at("store"), at("cube"))
    assert sum(run(*conform).values()) == 5
    first = run(*metrics)
    assert first["read"] == ["fu260107.zip"] and first["components"] > 20
    assert run(*metrics) == first | {"read": []}
    archive(folder, "fu260207", [LOAN_ROW], LOAN_HEADER)
    assert sum(run(*conform).values()) == 6
    assert run(*metrics)["read"] == ["fu260207.zip"]
