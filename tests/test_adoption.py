import pytest
from pyspark.sql import functions as F

from tidemark.operators import adoption as A
from tidemark.sources.journal import journal
from tidemark.sources.staging import staged

FOLDER = "/root/testdata/sf0.001"


class Crash(RuntimeError):
    pass


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def rows(spark):
    return staged(journal(spark, FOLDER))


@pytest.fixture(scope="module")
def whole(spark, rows, tmp_path_factory):
    job = A.journal_adoption(spark, rows, str(tmp_path_factory.mktemp("adoption") / "job"))
    assert job.run() == "ADOPTED"
    return job


@pytest.mark.parametrize("step", ["plan", "seeded", "replayed", "receipt"])
def test_a_crash_after_any_step_changes_nothing(spark, rows, whole, tmp_path, step):
    def told(name):
        if name == step:
            raise Crash

    with pytest.raises(Crash):
        A.journal_adoption(spark, rows, f"{tmp_path}/job", told=told).run()
    job = A.journal_adoption(spark, rows, f"{tmp_path}/job")
    if step != "receipt":  # without one, nothing was adopted
        assert rows_of(job.adopted().drop("step")) == rows_of(job.states)
    assert job.run() == ("ALREADY_ADOPTED" if step == "receipt" else "ADOPTED")
    assert rows_of(job.adopted()) == rows_of(whole.adopted())


def test_a_half_written_step_is_written_anew(spark, rows, whole, tmp_path):
    job = A.journal_adoption(spark, rows, f"{tmp_path}/job")
    whole.adopted().limit(1).write.parquet(f"{tmp_path}/job/seeded")
    (tmp_path / "job" / "seeded" / "_SUCCESS").unlink()
    assert job.run() == "ADOPTED" and rows_of(job.adopted()) == rows_of(whole.adopted())


def test_verification_counts_zero_until_something_changes(spark, rows, whole, tmp_path):
    assert whole.verified() == dict.fromkeys(A.ZERO, 0)
    job = A.journal_adoption(spark, rows, f"{tmp_path}/job")
    assert job.verified()["receipts_missing"] == 1
    assert job.run() == "ADOPTED"
    states = staged(job.adopted())
    changed = states.withColumn("status", F.when(F.col("order_hash") == states.first()["order_hash"], "paused").otherwise(F.col("status")))
    changed.write.mode("overwrite").parquet(f"{tmp_path}/job/replayed")
    found = job.verified()
    assert found["receipts_differing"] == 1 and found["states_differing"] == 2 and found["linked_missing"] == 0
    job.events = job.events.withColumn("processing_status", F.lit("pending"))
    assert job.verified()["events_unsafe"] == job.events.count()


def test_reset_begins_from_the_snapshot(spark, rows, tmp_path):
    job = A.journal_adoption(spark, rows, f"{tmp_path}/job", reset=True)
    assert job.run() == "ADOPTED"
    steps = {r["step"] for r in job.adopted().select("step").distinct().collect()}
    assert "reset" in steps and "attach" not in steps
    quiet = spark.read.parquet(f"{tmp_path}/job/seeded").where("step = 'reset'")
    assert quiet.where("status <> 'active' OR NOT is_active").isEmpty()


def test_refusals(spark, rows, tmp_path):
    def refused(name, change):
        job = A.journal_adoption(spark, rows, f"{tmp_path}/{name}")
        change(job)
        with pytest.raises(A.AdoptionRefused, match=name):
            job.run()
        assert not job.done("receipt")

    one = lambda df: df.limit(1)
    refused("INITIAL_BASELINE_DUPLICATE_ORDER", lambda j: setattr(j, "snapshot", j.snapshot.unionAll(staged(one(j.snapshot)))))
    refused("INITIAL_BASELINE_IDENTITY_MISMATCH", lambda j: setattr(j, "snapshot", j.snapshot.withColumn("seller", F.lit(None).cast("string"))))
    refused("INITIAL_BASELINE_SNAPSHOT_EXPIRED", lambda j: setattr(j, "now", 1 << 60))
    refused("INITIAL_BASELINE_EXISTING_IDENTITY_CONFLICT", lambda j: setattr(j, "states", j.states.withColumn("nft", F.lit("other"))))
    refused("INITIAL_BASELINE_EXISTING_ADOPTION_CONFLICT", lambda j: setattr(j, "states", j.states.withColumn("adoption_id", F.lit("other"))))
    refused("INITIAL_BASELINE_POST_STABLE_EVENT_UNSAFE_STATUS", lambda j: setattr(j, "events", j.events.withColumn("processing_status", F.lit("failed"))))
    refused("INITIAL_BASELINE_POST_STABLE_EVENT_MALFORMED", lambda j: setattr(j, "events", j.events.withColumn("chain", F.lit(None).cast("string"))))
