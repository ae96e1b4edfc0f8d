import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.joins import same_second_conflict
from tidemark.operators.reconcile import window_classification
from tidemark.sources.journal import journal
from tidemark.streaming import admission, barrier, conflicts

FOLDER = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def moves(spark):
    return barrier.window_moves(journal(spark, FOLDER))


def landed(spark, moves, folder, closed):
    """Transfers in four files in the order of their arrival."""
    rows = barrier.held(moves, F.col("source") == "rest", F.col("event_ms") >= barrier.WINDOW_END - barrier.HOUR, F.col("token_id"))
    arrived = rows.join(moves.select("event_id", F.ntile(4).over(Window.orderBy("received_ms", "event_id")).alias("file")), "event_id")
    for i in range(1, 5):
        arrived.where(F.col("file") == i).select(rows.columns).coalesce(1).write.mode("append").parquet(folder)
    if closed:
        barrier.closing(spark, barrier.WINDOW_END + 40 * 24 * barrier.HOUR).write.mode("append").parquet(folder)
    return folder


def test_seconds_are_released_as_they_close(spark, moves, tmp_path):
    """By arrival, transfers are at most five hours late: most are judged before the source closes, all as the whole window says."""
    expected = {r["event_id"]: r["class"] for r in window_classification(spark, FOLDER).collect()}
    open_ = barrier.run_barrier(spark, landed(spark, moves, f"{tmp_path}/open", closed=False), "5 hours", files_per_batch=1)
    early = {r["event_id"]: r["class"] for r in open_.collect()}
    assert set(early) == set(expected)
    assert sum(early[i] == c for i, c in expected.items()) > len(expected) * 0.9  # the rest still waits, and is not released
    closed = barrier.run_barrier(spark, landed(spark, moves, f"{tmp_path}/closed", closed=True), "5 hours", files_per_batch=1)
    assert {r["event_id"]: r["class"] for r in closed.collect()} == expected


def test_what_comes_too_late_is_uncertain_and_told_once(spark, moves):
    told = barrier.run_barrier(spark, barrier.land_shuffled(spark, moves, 5), "0 seconds", files_per_batch=1).collect()
    targets = {r["event_id"] for r in moves.where("source = 'rest'").collect()}
    assert len(told) == len(targets) and {r["event_id"] for r in told} == targets
    assert any(r["class"] == "UNCERTAIN" for r in told) and not any(r["applies"] for r in told if r["class"] != "SAFE")


def test_admission_is_bounded_and_repeats_nothing(spark, tmp_path):
    arrivals = admission.land_arrivals(journal(spark, FOLDER), 4)
    started = admission.admit(spark, arrivals, f"{tmp_path}/journal", f"{tmp_path}/checkpoint", "1 second", files_per_batch=1)
    started.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in started.recentProgress if p["stateOperators"]]
    keys = spark.read.parquet(arrivals).select("dedupe_key").distinct().count()
    found = spark.read.parquet(f"{tmp_path}/journal")
    assert found.count() == found.select("dedupe_key").distinct().count() == keys
    assert len(held) >= 5 and max(held) < keys * 0.95 and held[-1] < max(held)  # behind the horizon, keys leave the state

    # a crash after a batch was written and before it was committed: it runs again
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    before = rows_of(found)
    for n in (last, last - 1):
        (tmp_path / "checkpoint" / "commits" / str(n)).unlink(missing_ok=True)
        (tmp_path / "checkpoint" / "commits" / f".{n}.crc").unlink(missing_ok=True)
    admission.admit(spark, arrivals, f"{tmp_path}/journal", f"{tmp_path}/checkpoint", "1 second", files_per_batch=1).awaitTermination()
    assert rows_of(spark.read.parquet(f"{tmp_path}/journal").select(found.columns)) == before


def test_conflicts_are_those_of_the_batch_and_late_ones_are_unknown(spark):
    rows = journal(spark, FOLDER)
    expected = {r["event_id"]: r["conflict"] for r in same_second_conflict(spark, FOLDER).collect()}
    whole = {r["event_id"]: r["conflict"] for r in conflicts.run_conflicts(spark, conflicts.land_moves(rows, 4), "60 days", files_per_batch=1).collect()}
    assert whole == expected and any(expected.values())
    hasty = {r["event_id"]: r["conflict"] for r in conflicts.run_conflicts(spark, conflicts.land_moves(rows, 4), "1 day", files_per_batch=1).collect()}
    assert set(hasty) == set(expected) and None in hasty.values()
    assert not any(hasty[i] and not c for i, c in expected.items())
