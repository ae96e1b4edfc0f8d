import json

from tidemark.functions import json_text
from tidemark.operators import variant_probe as V

TEXTS = [
    '{"version": 1, "payload": {"order_hash": "x", "created_at": null, "item": {"nft_id": true, "chain": ["a", ["b"], {"contract": 1.5}]}}}',
    '{"transaction": "0x1", "a": {"transaction": "0x1"}, "from": {"address": "z"}, "to_address": [1, 2, 3, 4, 5, 6, 7]}',
    '{"event_version": 9007199254740993, "eventVersion": 12345678901234567890123, "d": {"version": -3}, "big": {"version": 9007199254740991}}',
    '{"a": {"b": {"c": {"d": {"nft": {"nft": 1}}}}}}', '[{"token_id": "1"}, {"hash": "h"}, 7]', '{"hash": 1, "hash": 2}', "{", "7", "null", '"hash"', "{}", "",
]


def test_variants_tell_the_same_fields_as_the_parser(spark):
    rows = spark.createDataFrame([*enumerate(TEXTS), (99, None)], "id long, payload string").repartition(3)

    def fields(text):
        try:
            return sorted(json_text.discover(json_text.parse(text)))
        except ValueError:
            return []

    found = {}
    for r in V.discovered(rows, "id", "payload").collect():
        found.setdefault(r["id"], []).append((r["concept"], r["path"], r["kind"]))
    assert {i: sorted(x) for i, x in found.items()} == {i: x for i, t in enumerate(TEXTS) if (x := fields(t))}


def test_bounds_are_kept_and_no_python_runs(spark):
    wide = json.dumps({f"nft{i:03}": i for i in range(300)})
    rows = spark.createDataFrame([(1, wide)], "id long, payload string")
    found = V.discovered(rows, "id", "payload", V.Bounds(fields=7))
    assert sorted(r["path"] for r in found.collect()) == [f"nft{i:03}" for i in range(7)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert V.discovered(rows, "id", "payload", V.Bounds(depth=1, items=0)).count() == 200


def test_a_payload_is_parsed_and_opened_once(spark):
    rows = spark.createDataFrame([("a", '{"x": {"y": [{"hash": "0x1"}]}}')], "id string, payload string")
    plan = V.discovered(rows, "id", "payload")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
