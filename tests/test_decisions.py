"""The rules on evidence, rung by rung, on rows made for each."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import json_text as J
from tidemark.functions import rules as R
from tidemark.operators import decisions as D
from tidemark.operators import generations as G
from tidemark.operators import observer as O
from tidemark.operators import verifier as V

ATTEMPT = dict(
    attempt_id=1, order_hash="o", attempt_ok=True, generation_ok=True, active_ok=True, journal_ok=True, later_ok=True, later_complete=True, later_hash="o", commitment=7, current_commitment=7, publication=3, sequence=5, active_publication=3,
    active_sequence=5, active_hash="o", presence="ABSENT", pre_fingerprint="f", post_fingerprint="f", ambiguous=False, journal_fingerprint="f", pre_ms=10, pre_id=1, post_ms=20, post_id=2, journal_ms=20, journal_id=2, active_ms=20, active_id=2,
    lifecycle="COMPLETE", provider_status="INACTIVE_CONFIRMED", final_status="INACTIVE_CONFIRMED", failure=None, retryable=False,
)
LATER = dict(attempt_id=1, entry=1, identity_ok=True, own_commitment=-1, published_ok=True, later_sequence=5, later_state="ACTIVE_CONFIRMED", later_final="ACTIVE_CONFIRMED", later_lifecycle="COMPLETE", later_failure=None, later_retryable=False, later_fence="ACTIVE_CONFIRMED", start_ms=30, start_id=3)


def frame(spark, rows):
    kinds = {bool: "boolean", int: "long", str: "string", type(None): "string"}
    types = {}
    for r in rows:
        for n, v in r.items():
            if v is not None or n not in types:
                types[n] = kinds[type(v)]
    return spark.createDataFrame([tuple(r[n] for n in types) for r in rows], ", ".join(f"{n} {t}" for n, t in types.items()))


#: Changes of the attempt and of the later attempt, with the verdict.
CASES = [
    ({}, None, "SHADOW_ELIGIBLE", ""),
    (dict(attempt_ok=False, journal_ok=False), None, "UNPROVEN", "INVALID_CANDIDATE_ATTEMPT,INVALID_CURRENT_JOURNAL"),
    (dict(generation_ok=False, active_ok=False), None, "UNPROVEN", "INVALID_ACTIVE_EVIDENCE,INVALID_CURRENT_GENERATION"),
    (dict(later_ok=False), None, "UNPROVEN", "LATER_PROVIDER_EVIDENCE_INVALID"),
    (dict(later_ok=False, later_complete=False), None, "UNPROVEN", "LATER_PROVIDER_EVIDENCE_UNPROVEN"),
    (dict(later_hash="x", current_commitment=8), None, "UNPROVEN", "LATER_PROVIDER_EVIDENCE_INVALID"),
    (dict(current_commitment=8, presence="PRESENT"), None, "SUPERSEDED", "CURRENT_GENERATION_MISMATCH"),
    (dict(active_sequence=4, journal_fingerprint="g"), None, "RECONCILIATION_REQUIRED", "ACTIVE_EVIDENCE_PUBLICATION_MISMATCH"),
    (dict(journal_fingerprint="g", journal_id=1), None, "RECONCILIATION_REQUIRED", "RELEVANT_JOURNAL_CHANGED"),
    (dict(journal_id=1, presence="PRESENT"), None, "RECONCILIATION_REQUIRED", "CURRENT_JOURNAL_WATERMARK_REGRESSION"),
    (dict(active_id=3, presence="PRESENT"), None, "RECONCILIATION_REQUIRED", "CURRENT_JOURNAL_BEHIND_ACTIVE_EVIDENCE"),
    (dict(pre_fingerprint="e", presence="PRESENT"), None, "RECONCILIATION_REQUIRED", "FENCE_A_UNPROVEN"),
    (dict(ambiguous=True), None, "RECONCILIATION_REQUIRED", "FENCE_A_UNPROVEN"),
    (dict(pre_id=9), None, "RECONCILIATION_REQUIRED", "FENCE_A_UNPROVEN"),
    (dict(pre_id=9, pre_ms=1), None, "RECONCILIATION_REQUIRED", "FENCE_A_UNPROVEN"),  # ids come before times
    (dict(pre_id=1, pre_ms=99), None, "SHADOW_ELIGIBLE", ""),
    (dict(presence="PRESENT", lifecycle="FAILED"), None, "BLOCKED_BY_LATER_EVIDENCE", "CURRENT_ACTIVE_EVIDENCE_PRESENT"),
    (dict(lifecycle="FAILED", failure="STALE"), None, "SHADOW_INELIGIBLE", "CANDIDATE_NOT_COMPLETE"),
    (dict(final_status="STALE"), {}, "SHADOW_INELIGIBLE", "ATTEMPT_NOT_INACTIVE_CONFIRMED"),
    (dict(failure="RETRY_EXHAUSTED"), None, "SHADOW_INELIGIBLE", "ATTEMPT_NOT_INACTIVE_CONFIRMED"),
    (dict(retryable=True), None, "SHADOW_INELIGIBLE", "ATTEMPT_NOT_INACTIVE_CONFIRMED"),
    ({}, {}, "BLOCKED_BY_LATER_EVIDENCE", "LATER_ACTIVE_CONFIRMED"),
    ({}, dict(start_ms=20, start_id=2), "RECONCILIATION_REQUIRED", "ACTIVE_ORDERING_UNPROVEN"),
    ({}, dict(start_id=1, start_ms=99), "SHADOW_ELIGIBLE", ""),
    ({}, dict(start_id=3, start_ms=5), "BLOCKED_BY_LATER_EVIDENCE", "LATER_ACTIVE_CONFIRMED"),
    ({}, dict(own_commitment=9, later_sequence=6), "BLOCKED_BY_LATER_EVIDENCE", "LATER_ACTIVE_CONFIRMED"),
    ({}, dict(own_commitment=9, later_sequence=5), "RECONCILIATION_REQUIRED", "ACTIVE_ORDERING_UNPROVEN"),
    ({}, dict(own_commitment=9, later_sequence=4), "SHADOW_ELIGIBLE", ""),
    ({}, dict(later_state="INACTIVE_CONFIRMED"), "SHADOW_ELIGIBLE", ""),
    ({}, dict(later_failure="STALE"), "SHADOW_ELIGIBLE", ""),
    ({}, dict(identity_ok=False), "RECONCILIATION_REQUIRED", "LATER_PROVIDER_EVIDENCE_INVALID"),
    ({}, dict(published_ok=False), "UNPROVEN", "LATER_PROVIDER_EVIDENCE_INVALID"),
    ({}, dict(later_fence="STALE"), "RECONCILIATION_REQUIRED", "LATER_PROVIDER_EVIDENCE_INVALID"),
]


def test_the_ladder_decides_each_case(spark):
    attempts = frame(spark, [{**ATTEMPT, **change, "attempt_id": i} for i, (change, *_) in enumerate(CASES)])
    later = frame(spark, [{**LATER, **change, "attempt_id": i} for i, (_, change, *_) in enumerate(CASES) if change is not None])
    found = {r["attempt_id"]: (r["state"], r["reasons"]) for r in D.decide(attempts, later).collect()}
    assert found == {i: (state, reasons) for i, (_, _, state, reasons) in enumerate(CASES)}
    reached = {r for _, _, _, text in CASES for r in text.split(",")}
    assert {n.partition(":")[2] for n, _ in (*D.LADDER, *D.LATER_PROBLEMS)} | {n for n, _ in D.UNPROVEN} <= reached


def test_the_first_unusable_later_attempt_decides(spark):
    later = frame(spark, [{**LATER, "entry": 2, "identity_ok": False}, {**LATER, "entry": 1, "published_ok": False}, {**LATER, "entry": 3}])
    assert [r["state"] for r in D.decide(frame(spark, [ATTEMPT]), later).collect()] == ["UNPROVEN"]


def test_two_passes_must_agree(spark):
    later = frame(spark, [{**LATER, "attempt_id": 99}])
    one = D.decide(frame(spark, [ATTEMPT, {**ATTEMPT, "attempt_id": 2}, {**ATTEMPT, "attempt_id": 3}]), later)
    two = D.decide(frame(spark, [ATTEMPT, {**ATTEMPT, "attempt_id": 2, "journal_id": 4}, {**ATTEMPT, "attempt_id": 3, "attempt_ok": False}]), later)
    assert {r["attempt_id"]: r["outcome"] for r in D.stable(one, two).collect()} == {1: "EVALUATED", 2: "SOURCE_CHANGED_DURING_EVALUATION", 3: "UNPROVEN"}


LOCAL = dict(order_hash="o", identity_hash="o", status="active", is_active=True, needs_reconciliation=False, created_ms=1, updated_ms=1, last_ms=100, last_version=2, identity_status="VALID", sweep_id=1)
EVENT = dict(order_hash="o", event_type="item_listed", processing_status="applied", event_ms=90, event_version=1, received_ms=1, unresolved=False, ambiguous=False)
BLOCKS = [
    (dict(status="sold"), {}, "ORDER_NOT_ACTIVE"), (dict(is_active=False), {}, "ORDER_NOT_ACTIVE"), (dict(needs_reconciliation=True), {}, "NEEDS_RECONCILIATION"), (dict(updated_ms=G.BASELINE + 1), {}, "ORDER_CREATED_OR_UPDATED_AFTER_BASELINE"), (dict(identity_hash="p"), {}, "INVALID_LOCAL_IDENTITY"),
    (dict(identity_status="UNSUPPORTED_LOCAL_SCOPE"), {}, "UNSUPPORTED_LOCAL_SCOPE"), (dict(identity_status="INVALID_LOCAL_IDENTITY"), {}, "INVALID_LOCAL_IDENTITY"), ({}, dict(event_type="item_minted"), "UNKNOWN_EVENT_TYPE"), ({}, dict(processing_status="paused"), "UNKNOWN_PROCESSING_STATUS"),
    ({}, dict(processing_status="pending"), "PENDING_EVENT"), ({}, dict(processing_status="processing"), "PROCESSING_EVENT"), ({}, dict(processing_status="failed"), "FAILED_EVENT"), ({}, dict(processing_status="reconciliation_required"), "UNRESOLVED_EVENT"), ({}, dict(unresolved=True), "UNRESOLVED_EVENT"),
    ({}, dict(ambiguous=True), "EVENT_ORDERING_AMBIGUOUS"), ({}, dict(event_ms=100, event_version=None), "EVENT_ORDERING_AMBIGUOUS"), ({}, dict(received_ms=G.BASELINE + 1), "NEWER_EVENT_AFTER_BASELINE"), ({}, dict(event_type="order_revalidate"), "REVALIDATE_UNVERIFIED"),
    ({}, dict(event_ms=101, event_type="item_sold"), "TERMINAL_EVENT_PRESENT"), ({}, dict(event_ms=100, event_version=3, event_type="item_cancelled"), "TERMINAL_EVENT_PRESENT"), ({}, dict(event_ms=99, event_type="item_sold"), ""),
]


def test_candidates_are_blocked_by_each_reason(spark):
    local = frame(spark, [{**LOCAL, "order_hash": str(i), "identity_hash": str(i), **{k: (v if k != "identity_hash" else "other") for k, v in change.items()}} for i, (change, _, _) in enumerate(BLOCKS)])
    events = frame(spark, [{**EVENT, "order_hash": str(i), **change} for i, (_, change, _) in enumerate(BLOCKS)])
    seen = frame(spark, [{"order_hash": str(i)} for i in range(len(BLOCKS))])
    found = {int(r["order_hash"]): (r["reasons"], r["class"]) for r in G.classify_candidates(local, seen, events, frame(spark, [dict(sweep_id=1, manifest="")])).collect()}
    assert found == {i: (why, "BLOCKED" if why else "PRESENT") for i, (_, _, why) in enumerate(BLOCKS)}


def test_repeated_identities_are_ambiguous_and_the_rest_is_present_or_absent(spark):
    local = frame(spark, [LOCAL, {**LOCAL, "order_hash": "p", "identity_hash": "p"}, {**LOCAL, "order_hash": "q", "identity_hash": "q"}, {**LOCAL, "order_hash": "q", "identity_hash": "q"}, {**LOCAL, "order_hash": "r", "identity_hash": "r"}])
    seen = frame(spark, [{"order_hash": h} for h in ("o", "r", "r")])
    found = sorted((r["order_hash"], r["class"], r["reasons"]) for r in G.classify_candidates(local, seen, frame(spark, [{**EVENT, "order_hash": "z"}]), frame(spark, [dict(sweep_id=1, manifest="")])).collect())
    again = ("BLOCKED", "IDENTITY_AMBIGUOUS")
    assert found == [("o", "PRESENT", ""), ("p", "ABSENT_CANDIDATE", ""), ("q", *again), ("q", *again), ("r", *again)]


SWEEP = dict(
    sweep_id=1, started_ms=1, completed_ms=2, sources=1, initial_state="OPEN", transport="COMPLETE", exhausted=True, truncated=False, malformed=0, conflicts=0, cycle=False, warnings=0, page_attempts=8, pages=7, http_attempts=9, retries=1, raw_pages=7,
    hashes=7, observed=5, normalised=5, details=8, successful=7, before_ms=10, before_id=1, after_ms=10, after_id=2, budget=4,
)
ROUND = dict(sweep_id=1, round=1, order_by=0, seen_ms=10, seen_id=2, pending=0, processing=0, failed=0, unresolved=0, unknown=0)


def test_a_snapshot_that_is_not_whole_blocks_all_its_orders(spark):
    """An order that such a snapshot doesn't show is no candidate."""
    local = frame(spark, [{**LOCAL, "order_hash": h, "identity_hash": h, "sweep_id": i} for i, h in enumerate("abcd")])
    manifests = frame(spark, [dict(sweep_id=i, manifest=m) for i, m in enumerate(("", "SNAPSHOT_NOT_COMPLETE", "SNAPSHOT_NOT_COMPLETE,SNAPSHOT_SEMANTICALLY_UNSAFE"))])
    found = {r["order_hash"]: (r["class"], r["reasons"]) for r in G.classify_candidates(local, frame(spark, [{"order_hash": "z"}]), frame(spark, [{**EVENT, "order_hash": "z"}]), manifests).collect()}
    assert found == {"a": ("ABSENT_CANDIDATE", ""), "b": ("BLOCKED", "SNAPSHOT_NOT_COMPLETE"), "c": ("BLOCKED", "SNAPSHOT_NOT_COMPLETE,SNAPSHOT_SEMANTICALLY_UNSAFE"), "d": ("BLOCKED", "SNAPSHOT_NOT_COMPLETE")}


CANDIDATE = dict(sweep_id=1, order_hash="o", **{"class": "ABSENT_CANDIDATE"}, identity_ok=True, row_authority=False)
BUNDLE = dict(sweep_id=1, model_ok=True, manifest_ok=True, bundle_authority=False, own_sweep=True)


def test_a_bad_bundle_keeps_sound_candidates_back(spark):
    changes = [({}, {}, ""), ({}, dict(model_ok=False), "INVALID_CANDIDATE_BUNDLE"), ({}, dict(manifest_ok=False), "INVALID_CANDIDATE_BUNDLE"), ({}, dict(bundle_authority=True), "INVALID_CANDIDATE_AUTHORITY"), ({}, dict(own_sweep=False), "CANDIDATE_SWEEP_MISMATCH"), (dict(row_authority=True), {}, "INVALID_CANDIDATE_AUTHORITY"), (dict(identity_ok=False), {}, "INVALID_CANDIDATE_IDENTITY"), ({"class": "GONE"}, {}, "UNKNOWN_CANDIDATE_CLASSIFICATION")]
    candidates = frame(spark, [{**CANDIDATE, "sweep_id": i, **c} for i, (c, _, _) in enumerate(changes)] + [{**CANDIDATE, "sweep_id": 50}])
    bundles = frame(spark, [{**BUNDLE, "sweep_id": i, **b} for i, (_, b, _) in enumerate(changes)])
    generations = frame(spark, [dict(sweep_id=i, state="VERIFIED") for i in (*range(len(changes)), 50)])
    found = {r["sweep_id"]: (r["reasons"], r["eligible"]) for r in G.advance_candidates(candidates, bundles, generations).collect()}
    assert found == {**{i: (why, why == "") for i, (_, _, why) in enumerate(changes)}, 50: ("INVALID_CANDIDATE_BUNDLE", False)}


def sweep_of(spark, change, rounds):
    given = frame(spark, [{**ROUND, "sweep_id": -1}, *({**ROUND, "round": i, **r} for i, r in enumerate(rounds))])
    (row,) = G.evaluate_generations(frame(spark, [{**SWEEP, **change}]), given).collect()
    return row["catch_up"], row["abort_reasons"], row["state"]


@pytest.mark.parametrize(
    "change, rounds, expected",
    [
        ({}, [{}, {}], ("STABLE", "", "VERIFIED")),
        ({}, [{}], ("NOT_STABLE", "CATCH_UP_NOT_STABLE", "ABORTED")),
        ({}, [{}, dict(seen_id=3), dict(seen_id=3)], ("STABLE", "", "VERIFIED")),
        ({}, [dict(seen_id=i) for i in range(2, 8)], ("BUDGET_EXHAUSTED", "CATCH_UP_BUDGET_EXHAUSTED", "ABORTED")),
        ({}, [dict(seen_id=i) for i in (2, 3, 4, 5, 5)], ("BUDGET_EXHAUSTED", "CATCH_UP_BUDGET_EXHAUSTED", "ABORTED")),
        ({}, [{}, dict(pending=1)], ("UNSAFE", "PENDING_EVENTS_AT_BARRIER", "ABORTED")),
        ({}, [dict(seen_id=0), dict(seen_id=0)], ("UNSAFE", "WATERMARK_REGRESSION", "ABORTED")),
        (dict(after_id=0), [{}, {}], ("UNSAFE", "WATERMARK_REGRESSION", "ABORTED")),
        (dict(raw_pages=6), [{}, {}], ("STABLE", "COUNTER_INCONSISTENT", "ABORTED")),
        (dict(transport="PARTIAL"), [{}, {}], ("STABLE", "SNAPSHOT_NOT_COMPLETE", "ABORTED")),
        (dict(transport="LOST"), [{}, {}], ("STABLE", "SNAPSHOT_NOT_COMPLETE,UNKNOWN_TRANSPORT_RESULT", "ABORTED")),
        (dict(malformed=1), [{}, {}], ("STABLE", "SNAPSHOT_SEMANTICALLY_UNSAFE", "ABORTED")),
        (dict(initial_state="VERIFIED"), [{}, {}], ("STABLE", "INVALID_INITIAL_STATE", "ABORTED")),
        (dict(sources=0), [{}, {}], ("STABLE", "INVALID_PROVENANCE,SNAPSHOT_NOT_COMPLETE", "ABORTED")),
    ],
)
def test_generations(spark, change, rounds, expected):
    assert sweep_of(spark, change, rounds) == expected


SEEN = dict(attempt_id=1, bound=True, transport="HTTP", http=200, body="LISTING", provider="ACTIVE", quantity=1, sent_ms=10**6, received_ms=10**6, date_ms=10**6, start_ms=1, end_ms=2 * 10**6)


@pytest.mark.parametrize(
    "change, status, reason",
    [
        ({}, "ACTIVE_CONFIRMED", ""), (dict(bound=False), "PROVENANCE_MISMATCH", "HTTP_STATUS_OR_BODY_UNPROVEN"), (dict(transport="TIMEOUT"), "TRANSPORT_FAILED", "REQUEST_TIMEOUT"), (dict(http=429), "RATE_LIMITED", "HTTP_429"), (dict(http=503), "TRANSPORT_FAILED", "HTTP_503"),
        (dict(http=520), "TRANSPORT_FAILED", "HTTP_5XX_PROVIDER_FAILURE"), (dict(http=409), "AMBIGUOUS", "HTTP_409_PROVIDER_CONFLICT"), (dict(http=404), "UNKNOWN", "HTTP_404_NOT_STATE_PROOF"), (dict(http=204), "UNKNOWN", "HTTP_STATUS_OR_BODY_UNPROVEN"), (dict(body="BROKEN"), "MALFORMED_RESPONSE", "MALFORMED_JSON"),
        (dict(quantity=0), "UNKNOWN", "ACTIVE_QUANTITY_UNPROVEN"), (dict(date_ms=None), "UNKNOWN", "ACTIVE_TIME_UNPROVEN"), (dict(start_ms=10**6), "UNKNOWN", "ACTIVE_TIME_UNPROVEN"), (dict(end_ms=10**6 + 1000), "UNKNOWN", "ACTIVE_TIME_UNPROVEN"), (dict(provider="INACTIVE"), "INACTIVE_CONFIRMED", ""),
        (dict(provider="INACTIVE", date_ms=10**7), "UNKNOWN", "OBSERVATION_TIME_INVALID"), (dict(provider="CANCELLED"), "TERMINAL_CONFIRMED", ""), (dict(provider="INACTIVE", end_ms=None), "UNKNOWN", "OBSERVATION_TIME_INVALID"), (dict(provider="FULFILLED", start_ms=None), "UNKNOWN", "OBSERVATION_TIME_INVALID"), (dict(provider="EXPIRED", start_ms=None, end_ms=5), "UNKNOWN", "OBSERVATION_TIME_INVALID"), (dict(provider="EXPIRED", end_ms=5), "EXPIRED_CONFIRMED", ""), (dict(provider="EXPIRED"), "UNKNOWN", "OBSERVATION_TIME_INVALID"), (dict(provider="LOST"), "UNKNOWN", "UNKNOWN_PROVIDER_STATUS"),
    ],
)
def test_provider_answers(spark, change, status, reason):
    (row,) = V.interpret(frame(spark, [{**SEEN, **change}])).collect()
    assert (row["status"], row["reason"]) == (status, reason)


@pytest.mark.parametrize("token, value", [("7", 7), ("-0", 0), ("1.0", 1), ("1e2", 100), ("120E-1", 12), ("0.5e1", 5), ("1.5", None), ("1e-1", None), ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("-9223372036854775808", -(2**63)), ("1e999999999999", None), ("0e999999999999", 0), ("01", None), ("x", None)])
def test_integers_of_json(token, value):
    assert J.bounded_integer(J.Token(token), 64) == value


def test_counters_and_shapes():
    assert J.is_counter("0") and J.is_counter("0xF") and J.is_counter(str(2**256 - 1)) and J.is_counter(J.Token("1e80"))
    assert not any(map(J.is_counter, ("01", "", "-1", str(2**256), "0x" + "f" * 65, None, J.Token("1.5"), J.Token("1e-9"))))
    assert J.fits({"a": "x"}, {"a": "text", "b?": 32}) and not J.fits({"a": "x", "b": "1"}, {"a": "text", "b?": 32}) and not J.fits({}, {"a": "text"}) and not J.fits({"a": [{}]}, {"a": [{"c": "text"}]})


def test_row_reasons_and_line_classes(spark):
    lines = spark.createDataFrame([(x,) for x in ("Successfully joined channel 'collection:a.b'", "Successfully joined channel collection:axb", "HTTP 401", "took 401ms", "x")], "m string")
    assert [r["c"] for r in lines.select(O.line_class(F.col("m"), "a.b").alias("c")).collect()] == ["joined", "socket_activity", "fatal_auth", "other", "other"]
    broken = O.violations(spark.createDataFrame([(1, "applied", 0), (2, None, 0), (3, "x", -1)], "event_id long, processing_status string, attempt_count int")).collect()
    assert {r["event_id"]: r["broken"] for r in broken} == {2: "STATUS_MISSING", 3: "ATTEMPTS_NEGATIVE,STATUS_UNKNOWN"}


def test_first_rule_wins_and_nulls_do_not_hold(spark):
    rows = spark.createDataFrame([(1,), (None,)], "x int")
    assert [r["v"] for r in rows.select(R.first((("A", "x = 1"), ("B", "x > 0"), ("C", "x IS NULL")), "D").alias("v")).collect()] == ["A", "C"]
    assert [r["v"] for r in rows.select(R.reasons((("B", "x = 1"), ("A", "x > 0"), ("B", "x < 5"))).alias("v")).collect()] == ["A,B", ""]
