import pytest

from ledgerline.plans import assistant, investigations, payload

PAYLOAD = {
    "latest": [{"report_period": "2024-01", "loan_count": 5.0, "loan_upb": 10.5, "30_plus_count": 0.1, "90_plus_count": 0.05}],
    "concentration": [{"report_period": "2024-01", "dimension": "state", "share": 0.4}, {"report_period": "2024-01", "dimension": "servicer", "share": 0.7}],
}


def test_answers_cite_facts():
    out = assistant.answer("Which concentration is highest?", PAYLOAD)
    assert out["citations"] == ["top_10_servicer@2024-01"] and "70.00%" in out["text"]
    out = assistant.answer("How many loans are there?", PAYLOAD)
    assert out["text"] == "loan_count is 5 [loan_count@2024-01]"


@pytest.mark.parametrize("question,reason", [("Should I buy this?", "advice"), ("select * from table", "query"), ("Who is the borrower?", "identity"), ("What is the weather?", "outside the evidence"), ("Predict the balance", "forecast")])
def test_refusals(question, reason):
    out = assistant.answer(question, PAYLOAD)
    assert out["status"] == "refused" and out["reason"] == reason


def test_unsupported_answers():
    known = assistant.facts(PAYLOAD)
    assert assistant.unsupported({"text": "loan_count is 6 [loan_count@2024-01]", "citations": ["loan_count@2024-01"]}, known)
    assert assistant.unsupported({"text": "x [y]", "citations": ["y"]}, known)
    with pytest.raises(ValueError):
        assistant.facts({"latest": [{"ssn": 1}]})


def test_investigations(spark, tmp_path):
    store = investigations.Store(spark, str(tmp_path / "log"))
    assert store.current().count() == 0
    one = store.create("Jump", "hhi_concentration", {"period": "2024-01"}, "ann")
    store.create("Other", "dti_metric", {}, "bob")
    assert store.update(one, 1, {"status": "resolved", "resolution": "a correction", "priority": "high"}, "ann") == 2
    with pytest.raises(investigations.Invalid):
        store.update(one, 1, {"status": "open"}, "bob")
    with pytest.raises(investigations.Invalid):
        store.update(one, 2, {"contract_id": "x"}, "bob")
    with pytest.raises(investigations.Invalid):
        store.create(" ", "x", {}, "ann")
    for changes in ({"status": "resolved"}, {"priority": "urgent"}, {"status": "closed"}, {"owner": "x" * 121}):
        with pytest.raises(investigations.Invalid):
            store.update(store.current("open").first().investigation_id, 1, changes, "bob")
    assert [(r.investigation_id, r.owner, r.priority) for r in store.current("resolved").collect()] == [(one, "ann", "high")]
    assert [r.action for r in store.audit(one).collect()] == ["create", "update"] and store.broken_chain().count() == 0


def test_two_changes_at_once(spark, tmp_path):
    """Both read version 1; one makes version 2, the other is refused, and the log has one of each."""
    from concurrent.futures import ThreadPoolExecutor

    store = investigations.Store(spark, str(tmp_path / "log"))
    one = store.create("Jump", "hhi_concentration", {}, "ann")
    before = {n: store.current().first()[n] for n in investigations.STATE}

    def change(who):
        try:
            store._append(one, 2, "update", who, before, before | {"owner": who})
            return who
        except investigations.Invalid:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = [w for w in pool.map(change, "abcdef") if w]
    assert len(won) == 1 and [r.owner for r in store.current().collect()] == won
    assert [r.version for r in store.audit(one).collect()] == [1, 2] and store.broken_chain().count() == 0


MONTH = {"security_count": 1, "issuance_upb": 2.0, "current_upb": 1.0, "average_factor": 0.5, "revision_count": 0}


def test_payloads_are_checked():
    good = {"months": [{"month": "2024-01"} | MONTH, {"month": "2024-02"} | MONTH], "mix": [], "metadata": {"quality": {"status": "pass"}, "period_start": "2024-01", "period_end": "2024-02"}}
    assert payload.validated(good) is good
    bad = [
        {k: v for k, v in good.items() if k != "mix"}, good | {"months": good["months"][:1]}, good | {"months": good["months"][::-1]}, good | {"months": [{"month": "2024-13"} | MONTH] * 2},
        good | {"months": [good["months"][0], {"month": "2024-02"} | MONTH | {"current_upb": float("nan")}]}, good | {"metadata": good["metadata"] | {"quality": {"status": "fail"}}}, good | {"metadata": good["metadata"] | {"period_end": "2024-03"}},
    ]
    for b in bad:
        with pytest.raises(payload.InvalidPayload):
            payload.validated(b)


def test_semantic_findings():
    rows = [{"report_period": f"2024-0{i}"} | {m: float(i) for m in payload.REQUIRED} for i in (1, 2)]
    found = payload.semantic_findings(rows, PAYLOAD["concentration"])
    assert found[0]["change"] == 1.0 and found[1]["change"] == 1.0 and found[-1]["measure"] == "top_10_servicer"
    with pytest.raises(payload.InvalidPayload):
        payload.semantic_findings([rows[0], rows[1] | {"loan_count": -1.0}], [])


def test_evidence_is_whole_or_refused(spark):
    from ledgerline import schemas as C

    names = [*C.KEY, "numerator", "denominator", "observations", "value", "released"]
    schema = ", ".join(f"{n} {'double' if n == 'value' else 'boolean' if n == 'released' else 'long' if n in ('numerator', 'denominator', 'observations') else 'string'}" for n in names)
    base = dict.fromkeys(names) | {"contract_id": "c", "report_period": "2024-01", "correction_view": "latest", "grain": "g", "dimension": "portfolio", "member": "All", "numerator": 1, "released": True}
    rows = [base | {"component": c} for c in payload.EVIDENCE.values()]
    rows += [base | {"component": "transition_count", "dimension": "delinquency_transition", "member": "Current to Current"}]
    partitions = [("2023-12", "a", "x", 3), ("2024-01", "b", "y", 4)]
    p = spark.createDataFrame(partitions, "report_period string, source_file string, checksum string, rows long")

    def bundle(rows, p=p, period=None):
        return payload.evidence_bundle(payload.evidence(spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema), p, period))

    found = bundle(rows + [base | {"component": "loan_upb", "report_period": "2023-12"}, base | {"component": "loan_upb", "correction_view": "original"}])
    assert set(found["metrics"]) == set(payload.EVIDENCE) and [s["source_file"] for s in found["metrics"]["outstanding_upb"]["provenance"]] == ["b"]
    assert [s["source_file"] for s in found["transitions"][0]["provenance"]] == ["a", "b"]
    for broken in (rows[1:], rows[:-1], [*rows, rows[0]], [r | {"released": r["component"] != "loan_upb"} for r in rows]):
        with pytest.raises(payload.InvalidPayload):
            bundle(broken)
    with pytest.raises(payload.InvalidPayload, match="source"):
        bundle(rows, p.where("source_file = 'a'"))
    with pytest.raises(payload.InvalidPayload):
        bundle(rows, period="2024-02")


def test_issuance_evidence():
    months = [{"month": f"2024-0{i}", "issuance_upb": u, "security_count": i} for i, u in ((1, 9.0), (2, 9.0), (3, 4.0))]
    mix = [{"month": "2024-03", "product_group": g, "issuance_upb": u} for g, u in (("A", 1.0), ("B", 3.0))]
    sources = {"2024-01": [{"source_file": "a"}], "2024-03": [{"source_file": "c"}]}
    found = payload.issuance_evidence(months, mix, sources)
    assert [(found[k]["report_period"], found[k]["member"], found[k]["value"]) for k in ("issuance_change", "issuance_peak", "issuance_mix")] == [("2024-03", "All", "4.0"), ("2024-01", "All", "9.0"), ("2024-03", "B", "3.0")]
    for broken in ((months[:1], mix, sources), (months, [], sources), (months, mix, {"2024-03": sources["2024-03"]})):
        with pytest.raises(payload.InvalidPayload):
            payload.issuance_evidence(*broken)
