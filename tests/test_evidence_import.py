import copy
import hashlib
import json

from tidemark.operators.evidence_import import imported


def document(**changes):
    snapshot = dict(
        result="COMPLETE", startedAt=1, completedAt=2, paginationExhausted=True, truncatedByPageLimit=False, truncatedByListingLimit=False, cursorCycleDetected=False, counters=dict(malformed=0, conflicts=0, normalized=3),
        rawPages=[{"listings": [{"order_hash": "0xA"}, {}]}, {"listings": []}, {"listings": [{"order_hash": "0xc"}]}], listings=[{"orderHash": "0xa", "b": 1, "rawListing": {"x": 1}}, {"orderHash": "0xB"}, {"orderHash": "0xc"}], responseHashes=["h1", "h2", "h3"],
    )
    snapshot = copy.deepcopy(snapshot) | changes
    return json.dumps({"snapshot": snapshot, "sourceProvenance": {"journal": "h"}})


CASES = [
    (document(), None), ("{", "evidence_read_or_json_failed"), (None, "evidence_read_or_json_failed"), ("{}", "evidence_snapshot_missing"), ('{"snapshot": null}', "evidence_snapshot_missing"),
    (document(paginationExhausted=False), "evidence_not_complete:SNAPSHOT_NOT_COMPLETE"), (document(counters=dict(malformed=1, conflicts=0, normalized=3)), "evidence_not_complete:SNAPSHOT_NOT_COMPLETE,SNAPSHOT_SEMANTICALLY_UNSAFE"), (document(completedAt=0), "evidence_not_complete:SNAPSHOT_NOT_COMPLETE"),
    (document(responseHashes=None), "evidence_payload_missing"), (document(responseHashes=["h1", "h2"]), "evidence_order_identity_missing"), (document(listings=[{"orderHash": "0xa"}, {"orderHash": "0xb"}]), "evidence_order_identity_missing"), (document(listings=[{"orderHash": "0xa"}, {}, {"orderHash": "0xc"}]), "evidence_order_identity_missing"),
    (document(listings=[{"orderHash": c} for c in "abcd"]), "evidence_listing_count_mismatch"), (document(counters=dict(malformed=0, conflicts=0, normalized=4)), "evidence_listing_count_mismatch"),
    (document(rawPages=[], listings=[], responseHashes=[], counters=dict(malformed=0, conflicts=0, normalized=0)), None),
]


def test_documents_are_imported_or_refused(spark):
    accounts, seen = imported(spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "sweep_id long, content string").repartition(3))
    assert {r["sweep_id"]: r["error"] for r in accounts.collect()} == {i: e for i, (_, e) in enumerate(CASES)}
    rows = sorted((r["sweep_id"], r["page_number"], r["order_hash"], r["page_hash"], r["material_hash"]) for r in seen.collect())
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert rows == [(0, 1, "0xa", "h1", digest('{"b":1,"orderHash":"0xa"}')), (0, 1, "0xb", "h1", digest('{"orderHash":"0xB"}')), (0, 3, "0xc", "h3", digest('{"orderHash":"0xc"}'))]
