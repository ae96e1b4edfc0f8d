import pytest

from tidemark.sources import ingress as I


def events(first, n):
    return [{"topic": "t" if i % 2 else "other", "type": "a" if i % 3 else "b", "body": {"i": i}} for i in range(first, first + n)]


def run(spark, folder, place, capacity=256):
    stream = I.topic_stream(spark, folder, "t", ("a",), capacity)
    I.land_topic(stream, f"{place}/landed", f"{place}/checkpoint").awaitTermination()


def offsets(spark, place):
    return sorted(r["offset"] for r in spark.read.schema(I.SCHEMA).parquet(f"{place}/landed").collect())


def test_restarts_lose_and_repeat_nothing(spark, tmp_path):
    log = I.StreamLog(f"{tmp_path}/log")
    total = 0
    for n in (10, 1, 25, 7):
        log.append(1, events(total, n))
        total += n
        run(spark, f"{tmp_path}/log", tmp_path)
    assert offsets(spark, tmp_path) == [i for i in range(total) if i % 2 and i % 3]
    # a batch that was written but not committed runs again under its number
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    (tmp_path / "checkpoint" / "commits" / str(last)).unlink()
    (tmp_path / "checkpoint" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    log.append(1, events(total, 4))
    for _ in range(2):  # such a run has one batch: first the old one, then what is new
        run(spark, f"{tmp_path}/log", tmp_path)
    assert offsets(spark, tmp_path) == [i for i in range(total + 4) if i % 2 and i % 3]


def test_overload_ends_the_query(spark, tmp_path):
    log = I.StreamLog(f"{tmp_path}/log")
    log.append(1, events(0, 20))
    run(spark, f"{tmp_path}/log", tmp_path, capacity=20)
    log.append(1, events(20, 21))
    with pytest.raises(Exception, match="events wait, at most 20"):
        run(spark, f"{tmp_path}/log", tmp_path, capacity=20)
    assert max(offsets(spark, tmp_path)) < 20


def test_a_second_epoch_ends_the_query(spark, tmp_path):
    log = I.StreamLog(f"{tmp_path}/log")
    log.append(1, events(0, 5))
    run(spark, f"{tmp_path}/log", tmp_path)
    log.append(2, events(0, 5))
    with pytest.raises(Exception, match="began in epoch 1, now 2"):
        run(spark, f"{tmp_path}/log", tmp_path)
