import hashlib
import json

from tidemark.operators import fences as V

FENCE = dict(order_hash="o", watermark_id="12", watermark_at="2024-01-20T00:00:00.000Z", ordering_ambiguous=False)
ENTRY = dict(event_type="item_listed", entry_hash="o", event_version=None)


def entries(*ids, **changes):
    return [{**ENTRY, "place": i, "listed_id": x, "event_id": x, **changes} for i, x in enumerate(ids)]


CASES = [
    ({}, [], ""), ({}, entries("1", "9", "10", "123456789012345678901234567890"), ""), ({}, entries("1", event_version="7"), ""),
    (dict(watermark_id="012"), [], "WATERMARK_INVALID"), (dict(watermark_at="today"), [], "WATERMARK_INVALID"), (dict(ordering_ambiguous=None), [], "ORDERING_AMBIGUITY_UNKNOWN"),
    ({}, entries("01"), "FINGERPRINT_EVENT_ID_INVALID,FINGERPRINT_EVENT_INVALID"), ({}, entries("1", event_id="2"), "FINGERPRINT_EVENTS_APART_FROM_IDS"), ({}, entries("1", event_id=None), "FINGERPRINT_EVENTS_APART_FROM_IDS,FINGERPRINT_EVENT_INVALID"),
    ({}, entries("10", "9"), "FINGERPRINT_IDS_UNORDERED"), ({}, entries("9", "9"), "FINGERPRINT_IDS_REPEATED"), ({}, entries("1", event_type="item_minted"), "FINGERPRINT_EVENT_INVALID"), ({}, entries("1", event_version="1.0"), "FINGERPRINT_EVENT_INVALID"),
    ({}, entries("1", entry_hash="p"), "FINGERPRINT_OF_OTHER_ORDER"),
]


def test_fences_are_judged_by_watermark_ids_and_events(spark):
    fences = spark.createDataFrame([{"fence_id": i, **FENCE, **change} for i, (change, _, _) in enumerate(CASES)], "fence_id long, order_hash string, watermark_id string, watermark_at string, ordering_ambiguous boolean")
    rows = [{"fence_id": i, **e} for i, (_, some, _) in enumerate(CASES) for e in some]
    listed = spark.createDataFrame(rows, "fence_id long, place long, listed_id string, event_id string, event_type string, entry_hash string, event_version string")
    found = {r["fence_id"]: r["reasons"] for r in V.validated_fences(fences, listed).collect()}
    assert found == {i: why for i, (_, _, why) in enumerate(CASES)}


def test_ids_hash_canonical_json_and_repeats_are_told(spark):
    base = dict(sweep_id="s", candidate_hash="c", barrier_hash="b", root_hash="r", candidate_model="v3", generation_model="v2", schema_version="4", policy_version="8", contract_version="3", normalizer_version="5", request='{"orderHash":"o"}', expected='{"tokenId":"1"}', attempt_number=0, provider="ACTIVE", reasons="[]", body_hash="h")
    rows = [base, base, {**base, "attempt_number": 1}, {**base, "attempt_number": 2}, {**base, "attempt_number": 2, "body_hash": "other"}]
    frame = spark.createDataFrame(rows)
    material = {
        "sweepId": "s", "candidateArtifactHash": "c", "barrierArtifactHash": "b", "generationRootHash": "r", "candidateModelVersion": "v3", "generationModelVersion": "v2", "verifierSchemaVersion": "4", "verifierPolicyVersion": "8",
        "providerContractVersion": "3", "normalizerVersion": "5", "requestIdentity": {"orderHash": "o"}, "expectedIdentity": {"tokenId": "1"}, "attemptNumber": 0,
    }
    digest = lambda value: hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    first = V.identified(frame).first()
    assert first["attempt_key"] == digest(material)
    assert first["semantic_hash"] == digest({**material, "normalizedProviderStatus": "ACTIVE", "reasonCodes": [], "responseBodySha256": "h"})
    assert sorted((r["attempts"], r["verdict"]) for r in V.settled_attempts(frame).collect()) == [(1, "ONCE"), (2, "CONFLICT"), (2, "REPEATED")]
