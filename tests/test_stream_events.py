import json

from tidemark.operators.stream_events import PROFILES, captured, normalise_events


def normalised(spark, *events):
    rows = spark.createDataFrame([(i, e if isinstance(e, str) or e is None else json.dumps(e)) for i, e in enumerate(events)], "i int, raw string")
    return {r["i"]: r for r in normalise_events(rows, "raw").collect()}


def test_listing_fields_and_issues(spark):
    payload = {
        "order_hash": "0xA", "item": {"nft_id": "chain/0xAB/7", "metadata": {"name": "N"}}, "maker": {"address": "0xM"}, "base_price": "1500000000000000000", "sale_price": "1", "payment_token": {"decimals": 18, "address": "0xT"},
        "event_timestamp": "2024-01-02T03:04:05.678901Z", "listing_date": "1704164645", "expiration_date": "2024-02-02T00:00:00Z",
        "protocol_data": {"parameters": {"offerer": "0xm", "offer": [{"token": "0xab", "identifierOrCriteria": "7"}]}},
    }
    listing = {"event_type": "item_listed", "version": 3, "payload": payload}
    odd = json.loads(json.dumps(listing).replace('"0xab"', '"0xcd"').replace('"0xm"', '"0xo"')) | {"version": 2**70}
    rows = normalised(spark, listing, odd, {**listing, "event_type": "item_sold"}, {**listing, "event_type": "order_revalidate"}, {**listing, "event_type": "other"}, "not json", None)
    r = rows[0]
    assert (r["event_ms"], r["event_version"], r["price"], r["contract_address"], r["nft_id"], r["token_address"], r["listing_ms"]) == (1_704_164_645_678, 3, "1.5", "0xab", "chain/0xAB/7", "0xt", 1_704_164_645_000)
    assert not r["suspicious"] and r["item_name"] == "N"
    assert rows[1]["issues"] == "nft_contract_disagrees_with_protocol_offer,maker_disagrees_with_protocol_offerer,event_version_invalid_or_unsafe" and rows[1]["event_version"] is None
    assert rows[2]["price"] == "0.000000000000000001"
    assert rows[3]["suspicious"] and rows[3]["seller"] is None and rows[3]["price"] is None and rows[3]["expiration_ms"] is None
    assert all(rows[i]["event_type"] is None for i in (4, 5, 6))


def test_transfer_hints(spark):
    zero = "0x" + "0" * 40
    ends = [(zero, "0xB"), ("0xA", zero), ("0xA", "0xB"), (None, "0xB")]
    rows = normalised(spark, *({"event_type": "item_transferred", "payload": {"from_account": {"address": a}, "to_account": {"address": b}, "transaction": {"hash": "0xT", "timestamp": "1704164645"}}} for a, b in ends))
    assert [rows[i]["transfer_hint"] for i in range(4)] == ["zero_source", "zero_destination", "wallet_to_wallet", "unknown"]
    assert rows[0]["transaction_ms"] == 1_704_164_645_000 and rows[0]["order_hash"] is None


def test_profiles(spark):
    rows = spark.createDataFrame([(t,) for t in (*PROFILES["all"], "other")], "event_type string")
    assert captured(rows, "orders").count() == 5 and captured(rows, "transfers").count() == 1
