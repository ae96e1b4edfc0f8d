from pyspark.sql import functions as F

from tidemark.operators import long_folds
from tidemark.operators.folds import STATE_COLUMNS, order_states
from tidemark.sources.journal import journal, read
from tidemark.streaming import state

SMALL = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def hot(spark):
    return journal(spark, SMALL).withColumn("order_hash", F.expr(long_folds._HOT)).where("order_hash IS NOT NULL")


def test_long_histories_fold_in_turns_as_in_one(spark):
    expected = rows_of(order_states(hot(spark)).select("order_hash", *STATE_COLUMNS))
    for parts, turn in ((12, 1), (5, 3)):
        assert rows_of(long_folds.long_fold(hot(spark), "order_hash", parts, turn).where("here").select("order_hash", *STATE_COLUMNS)) == expected


def test_a_key_that_spans_parts_is_never_in_one_row(spark):
    events = long_folds.placed(hot(spark), "order_hash", long_folds.ORDER_EVENT, 12)
    spread = events.where("order_hash = 'hot'").groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).orderBy("part").collect()
    assert len(spread) > 3 and all(a["high"] <= b["low"] for a, b in zip(spread, spread[1:]))


def test_stream_keeps_state_between_batches(spark, tmp_path):
    """Three files, one a batch, in arrival order: versions, prices and expiries of earlier batches stay."""
    events = read(spark, SMALL, "events").orderBy("ts", "event_id").toPandas()
    folder = tmp_path / "t" / "events.parquet"
    folder.mkdir(parents=True)
    step = -(-len(events) // 3)
    schema = read(spark, SMALL, "events").schema
    for i in range(3):
        part = spark.createDataFrame(events.iloc[i * step : (i + 1) * step], schema).coalesce(1)
        part.write.parquet(f"{tmp_path}/part{i}")
        next((tmp_path / f"part{i}").glob("part-*.parquet")).rename(folder / f"{i}.parquet")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", state.ROCKS)
    place = f"{tmp_path}/out"

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{place}/{number}")

    try:
        stream = state.order_state_stream(state.event_stream(spark, f"{tmp_path}/t", files_per_batch=1))
        stream.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    touched = spark.read.parquet(f"{place}/*")
    assert touched.select("batch").distinct().count() == 3
    newest = touched.groupBy("order_hash").agg(F.max_by(F.struct(*STATE_COLUMNS), "batch").alias("s")).select("order_hash", "s.*")
    assert rows_of(newest) == rows_of(order_states(journal(spark, SMALL).where("order_hash IS NOT NULL")).select("order_hash", *STATE_COLUMNS))


def test_streamed_events_are_folded_without_frames(monkeypatch):
    """An order's few events are read as lists; missing values of any kind are None to the rules."""
    import pandas as pd

    from tidemark.functions.order_rules import empty, reduce_order
    from tidemark.operators.folds import ORDER_EVENT, STATE_COLUMNS

    class Held:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    def refused(*args, **kwargs):
        raise AssertionError("an operation on whole frames for one key")

    listed = {**dict.fromkeys(ORDER_EVENT), "at": "2", "id": "7", "type": "item_listed", "ms": "10", "ver": float("nan"), "ord": "o", "nft": "n", "seller": "s", "price": "5", "exp": "99", "suspicious": False}
    sold = {**listed, "at": "3", "id": "8", "type": "item_sold", "ms": "11", "ver": "9007199254740993"}
    frame = pd.DataFrame([sold, listed])
    fold = state.OrderFold()
    fold.state = Held()
    monkeypatch.setattr(state.pd, "concat", refused)
    found = list(fold.handleInputRows(("o",), iter([frame]), None))
    want = empty()
    for event in ({**listed, "at": 2, "id": 7, "ms": 10, "ver": None, "exp": 99}, {**sold, "at": 3, "id": 8, "ms": 11, "ver": 9007199254740993, "exp": 99}):
        want = reduce_order(want, event)
    assert want["status"] == "sold" and fold.state.value == tuple(want.values())
    assert [tuple(f.iloc[0]) for f in found] == [("o", *(want[n] for n in STATE_COLUMNS))]
