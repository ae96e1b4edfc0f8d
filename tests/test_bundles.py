from tidemark.operators import bundles as B
from tidemark.operators.evidence_store import CANDIDATE_MODEL

BUNDLE = dict(sweep_name="s", model=CANDIDATE_MODEL, bundle_authority=False, started_ms=1, completed_ms=2, sources=1, manifest_eligible=True, count_present=1, count_absent=1, count_blocked=0, count_total=2)
ORDER = dict(reasons="", order_authority=False, identity_status="VALID")
ENTRY = dict(event_type="item_listed", processing_status="applied", received_ms=1, event_version=None)
A, Z = "0x" + "a" * 64, "0x" + "f" * 64
BAD, AUTHORITY = "INVALID_CANDIDATE_BUNDLE", "INVALID_CANDIDATE_AUTHORITY"

#: Changes of the bundle, of its second order, of its first entry, with the verdict.
CASES = [
    ({}, {}, {}, ""), (dict(sweep_name=" "), {}, {}, BAD), (dict(model="v1"), {}, {}, AUTHORITY), (dict(bundle_authority=True), {}, {}, AUTHORITY), (dict(completed_ms=0), {}, {}, BAD), (dict(sources=0), {}, {}, BAD), (dict(manifest_eligible=False), {}, {}, BAD),
    (dict(count_present=2), {}, {}, BAD), (dict(count_total=None), {}, {}, BAD), ({}, dict(order_authority=None), {}, AUTHORITY), ({}, dict(order_hash="0x1", identity_hash="0x1"), {}, f"{BAD},INVALID_CANDIDATE_IDENTITY"), ({}, dict(identity_hash=A), {}, "INVALID_LOCAL_IDENTITY"),
    ({}, dict(identity_status="UNSUPPORTED_LOCAL_SCOPE"), {}, "UNSUPPORTED_LOCAL_SCOPE"), ({}, dict(order_hash=A, identity_hash=A), {}, "IDENTITY_AMBIGUOUS"), ({}, {"class": "LOST"}, {}, BAD), ({}, dict(seen=True), {}, BAD), ({}, dict(seen=None), {}, BAD), ({}, dict(reasons="FAILED_EVENT"), {}, BAD),
    (dict(count_absent=0, count_blocked=1), {"class": "BLOCKED", "reasons": "FAILED_EVENT,PENDING_EVENT"}, {}, ""), (dict(count_absent=0, count_blocked=1), {"class": "BLOCKED", "reasons": "PENDING_EVENT,FAILED_EVENT"}, {}, BAD), (dict(count_absent=0, count_blocked=1), {"class": "BLOCKED", "reasons": "FAILED_EVENT,FAILED_EVENT"}, {}, BAD),
    (dict(count_absent=0, count_blocked=1), {"class": "BLOCKED", "reasons": "NO_SUCH"}, {}, BAD), (dict(count_absent=0, count_blocked=1), {"class": "BLOCKED"}, {}, BAD), ({}, {}, dict(told_id="x"), BAD), ({}, {}, dict(event_type=None), BAD), ({}, {}, dict(processing_status="paused"), BAD), ({}, {}, dict(received_ms=None), BAD),
    ({}, {}, dict(event_version=" "), BAD), ({}, {}, dict(listed_id="e9", told_id="e9"), BAD),
]


def test_each_fault_of_a_bundle_is_told(spark):
    bundles = [{"bundle_id": i, **BUNDLE, **change} for i, (change, *_) in enumerate(CASES)]
    orders, entries = [], []
    for i, (_, order, entry, _) in enumerate(CASES):
        first = {**ORDER, "bundle_id": i, "place": 1, "order_hash": A, "identity_hash": A, "class": "PRESENT", "seen": True}
        second = {**ORDER, "bundle_id": i, "place": 2, "order_hash": Z, "identity_hash": Z, "class": "ABSENT_CANDIDATE", "seen": False, **order}
        orders += [first, second]
        entries += [{**ENTRY, "bundle_id": i, "place": 1, "nth": n, "listed_id": f"e{n}", "told_id": f"e{n}", **(entry if n == 1 else {})} for n in (1, 2)]
    frame = spark.createDataFrame
    found = B.audited_bundles(
        frame(bundles, "bundle_id long, sweep_name string, model string, bundle_authority boolean, started_ms long, completed_ms long, sources int, manifest_eligible boolean, count_present long, count_absent long, count_blocked long, count_total long"),
        frame(orders, "bundle_id long, place int, order_hash string, class string, reasons string, seen boolean, order_authority boolean, identity_status string, identity_hash string"),
        frame(entries, "bundle_id long, place int, nth int, listed_id string, told_id string, event_type string, processing_status string, received_ms long, event_version string"),
    )
    assert {r["bundle_id"]: r["reasons"] for r in found.collect()} == {i: why for i, (*_, why) in enumerate(CASES)}


def test_a_bundle_without_orders_is_sound_if_it_counts_none(spark):
    frame = spark.createDataFrame
    bundle = [{"bundle_id": 1, **BUNDLE, "count_present": 0, "count_absent": 0, "count_total": 0}]
    found = B.audited_bundles(
        frame(bundle, "bundle_id long, sweep_name string, model string, bundle_authority boolean, started_ms long, completed_ms long, sources int, manifest_eligible boolean, count_present long, count_absent long, count_blocked long, count_total long"),
        frame([], "bundle_id long, place int, order_hash string, class string, reasons string, seen boolean, order_authority boolean, identity_status string, identity_hash string"),
        frame([], "bundle_id long, place int, nth int, listed_id string, told_id string, event_type string, processing_status string, received_ms long, event_version string"),
    )
    assert [tuple(r) for r in found.collect()] == [(1, 0, "")]


def test_lines_are_dealt_out_once(spark):
    """All branches of the query have one shuffle of the lines in common."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = B.bundle_audit(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    reused = plan.count("ReusedExchange")
    assert reused >= 4 and plan.count("REPARTITION_BY_COL") - reused == 2  # the counts need no places, so they have their own


def test_nothing_but_tables_is_shuffled(spark):
    """Lines twice and orders once, as without broadcasts; no order or entry is shuffled to meet the one before it."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        plan = B.bundle_audit(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in changed:
            spark.conf.unset(k)
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 3


def test_rows_meet_the_one_before_at_any_edge_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 3)
    places = [("a", p, f"v{p}") for p in range(1, 12)] + [("b", p, f"w{p}") for p in (2, 3, 5, 5, 6, 9)] + [("b", 5, "w9"), ("c", None, "x")]
    rows = spark.createDataFrame(places, "key string, place int, value string")
    found = B.beside_the_last(rows, ["key"], "place", "value", "before")
    at = {(k, p): max(v for key, q, v in places if (key, q) == (k, p)) for k, p, _ in places}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((k, p, v, at.get((k, p - 1)) if p else None) for k, p, v in places), key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "block#" in plan.split("hashpartitioning(key", 1)[1].split(")", 1)[0]  # a long group is spread


def test_a_fault_of_order_is_told_at_any_place(spark, monkeypatch):
    """Bundle i has five orders of five entries each, and its i-th order or entry lies before its time."""
    monkeypatch.setattr(B, "BLOCK", 2)
    frame, hashes = spark.createDataFrame, ["0x" + c * 64 for c in "12345"]
    bundles = [{"bundle_id": i, **BUNDLE, "count_present": 5, "count_absent": 0, "count_total": 5} for i in range(10)]
    orders, entries = [], []
    for i in range(10):
        swap = lambda xs, k: xs if not k else [*xs[: k - 1], xs[k], xs[k - 1], *xs[k + 1 :]]
        for place, h in enumerate(swap(hashes, i if i < 5 else 0), 1):
            orders.append({**ORDER, "bundle_id": i, "place": place, "order_hash": h, "identity_hash": h, "class": "PRESENT", "seen": True})
            listed = swap([f"e{n}" for n in range(1, 6)], i - 5 if i > 5 and place == 3 else 0)
            entries += [{**ENTRY, "bundle_id": i, "place": place, "nth": n, "listed_id": e, "told_id": e} for n, e in enumerate(listed, 1)]
    found = B.audited_bundles(
        frame(bundles, "bundle_id long, sweep_name string, model string, bundle_authority boolean, started_ms long, completed_ms long, sources int, manifest_eligible boolean, count_present long, count_absent long, count_blocked long, count_total long"),
        frame(orders, "bundle_id long, place int, order_hash string, class string, reasons string, seen boolean, order_authority boolean, identity_status string, identity_hash string"),
        frame(entries, "bundle_id long, place int, nth int, listed_id string, told_id string, event_type string, processing_status string, received_ms long, event_version string"),
    )
    assert {r["bundle_id"]: (r["orders"], r["reasons"]) for r in found.collect()} == {i: (5, BAD if i % 5 else "") for i in range(10)}
