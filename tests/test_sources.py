import json

import duckdb
from pyspark.sql import functions as F

from tests.compare import assert_same
from tidemark.operators.listings import normalise_listings
from tidemark.plans.catalogue import ORACLES, QUERIES
from tidemark.sources import pages as P

SMALL = "/root/testdata/sf0.001"


def test_manifest_of_landed_pages(spark, tmp_path):
    made = [
        ("full", 1, "a", ["x", "y"]), ("full", 2, None, ["z"]), ("cycle", 1, "a", ["x"]), ("cycle", 2, "a", ["y"]), ("cycle", 3, None, ["z"]), ("same", 1, "a", ["x"]), ("same", 2, None, ["x"]),
        ("open", 1, "a", ["x"]), ("gap", 1, "a", ["x"]), ("gap", 3, None, ["y"]),
    ]
    lines = [json.dumps({"sweep_id": s, "page_number": n, "next_cursor": c, "listings": x}) for s, n, c, x in made]
    (tmp_path / "pages.json").write_text("\n".join(lines))
    pages = P.read_pages(spark, str(tmp_path / "pages.json"))
    assert {r["sweep_id"]: r["complete"] for r in P.manifest(pages).collect()} == {"full": True, "cycle": False, "same": False, "open": False, "gap": False}
    assert P.manifest(pages, most_rows=2).where("sweep_id = 'full'").first()["truncated"]


def test_artifacts_are_written_once_and_verified(spark, tmp_path):
    path = str(tmp_path / "artifact")
    P.write_artifact(spark.range(20).repartition(2), path)
    declared = P.artifact_manifest(spark, path).collect()
    table = spark.createDataFrame(declared)
    assert {r["status"] for r in P.verify_artifact(spark, path, table).collect()} == {"COMPLETE"}
    assert P.root_hash(table) == P.root_hash(table.orderBy("sha256"))
    changed = spark.createDataFrame([(declared[0]["name"], declared[0]["length"], "0" * 64), ("part-lost", 1, "0" * 64)], table.schema)
    assert {r["name"]: r["status"] for r in P.verify_artifact(spark, path, changed).collect()} == {declared[0]["name"]: "CORRUPT", "part-lost": "INCOMPLETE", declared[1]["name"]: "UNDECLARED"}
    try:
        P.write_artifact(spark.range(1), path)
    except Exception as e:
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)
    else:
        raise AssertionError("a second write must fail")


def test_transition_chain(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("a", 1, None, "OPEN"), ("a", 2, "OPEN", "DONE"), ("b", 1, None, "OPEN"), ("b", 2, "DONE", "X")], "id string, sequence int, from_state string, to_state string")
    assert [r["id"] for r in P.transition_chain(rows, F.col("id")).collect()] == ["b"]


def test_listing_amounts_are_exact(spark):
    def listing(price, *amounts):
        return json.dumps({"order_hash": "0xA", "status": "ACTIVE", "asset": {"identifier": "9007199254740993"}, "price": {"current": {"value": price, "decimals": 18}}, "offer": [{"identifier": "1"}], "consideration": [{"startAmount": a, "endAmount": a} for a in amounts]})

    large = "1" + "0" * 29
    rows = spark.createDataFrame([(1, listing(large, large[:-1] + "0", "0")), (2, listing(large, large, "1")), (3, listing("x", "1")), (4, listing("1")), (5, "{"), (6, listing("9" * 38, "9" * 38, "9" * 38))], "i int, raw string")
    found = {r["i"]: (r["outcome"], r["price"]) for r in normalise_listings(rows, "raw").collect()}
    assert found == {1: ("ok", "100000000000.0"), 2: ("consideration_price_mismatch", None), 3: ("price_invalid", None), 4: ("consideration_missing_or_empty", None), 5: ("malformed_json", None), 6: ("consideration_price_mismatch", None)}


def test_listing_whose_price_is_nothing_equals_its_sql(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet").where("event_type IN ('view', 'purchase')").limit(200)
    events.withColumn("value", F.when(F.col("event_id") % 2 == 0, 0.0).otherwise(F.col("value"))).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert_same(QUERIES["listing_normalisation"](spark, str(tmp_path)), connection, ORACLES["listing_normalisation"])
