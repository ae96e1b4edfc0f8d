import pytest

from tidemark.sources import sinks as K


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_append_is_idempotent_and_keeps_the_first(spark):
    there = spark.createDataFrame([("a", 1, "x")], "key string, at int, v string")
    new = spark.createDataFrame([("a", 2, "y"), ("b", 5, "late"), ("b", 3, "first"), ("c", 1, None)], there.schema)
    fresh = K.append_new(there, new, ["key"], ["at"])
    assert rows(fresh) == [("b", 3, "first"), ("c", 1, None)]
    assert K.append_new(there.unionAll(fresh), new, ["key"], ["at"]).count() == 0
    assert rows(K.conflicts(there, new, ["key"], "v")) == [("a", 2, "y")]


def test_upsert_keeps_created_at_and_untouched_rows(spark):
    state = spark.createDataFrame([("a", "old", 1), ("b", "same", 2)], "key string, status string, created_at int")
    changes = spark.createDataFrame([("a", None, 9), ("c", "new", 9)], state.schema)
    assert rows(K.upsert(state, changes, ["key"])) == [("a", None, 1), ("b", "same", 2), ("c", "new", 9)]


def test_compare_and_set(spark):
    state = spark.createDataFrame([(1, "pending"), (2, "applied"), (3, "pending")], "id int, status string")
    done = K.compare_and_set(state, "status", "pending", "processing", spark.createDataFrame([(1,), (2,), (1,)], "id int"), "id")
    assert rows(done) == [(1, "processing", True), (2, "applied", False), (3, "pending", False)]
    with pytest.raises(ValueError):
        K.expect_rows(done.where("changed"), 2, "claim")


def test_sequences_and_links(spark):
    there = spark.createDataFrame([("s", 4)], "scope string, sequence int")
    new = spark.createDataFrame([("s", "x"), ("s", "y"), ("t", "z")], "scope string, id string")
    assert rows(K.allocate_sequence(there, new, "scope", "sequence", ["id"]).select("id", "sequence")) == [("x", 5), ("y", 6), ("z", 1)]
    again = spark.createDataFrame([("a", "x", 5), ("b", "y", 1)], "scope string, id string, sequence int")
    assert rows(K.allocate_sequence(again, new.unionAll(new), "scope", "sequence", ["id"], ["id"]).select("id", "sequence")) == [("z", 1)]
    chain = spark.createDataFrame([("a", "d1", 1, None), ("a", "d2", 2, "d1"), ("a", "d3", 3, "d1")], "attempt string, id string, n int, previous_id string")
    assert [r["sound"] for r in K.linked(chain, ["attempt"], "id", "n").orderBy("n").collect()] == [True, True, False]


def test_payload_mismatches_and_schemas(spark):
    table = spark.createDataFrame([(1, '{"id": 1, "s": "x"}', "x"), (2, '{"id": 3}', None), (4, '{"id": 4, "s": "q"}', None)], "id int, payload string, s string")
    assert rows(K.mismatches(table, "payload", {"id": "$.id", "s": "$.s"}).select("id", "reasons")) == [(2, "id_mismatch"), (4, "s_mismatch")]
    assert K.schema_problems(table, {"id": "bigint", "x": "int", "payload": "string"}) == ["missing:x", "type:id:int", "unexpected:s"]
    assert K.same_rows(table, table.repartition(2)) and not K.same_rows(table, table.unionAll(table))
