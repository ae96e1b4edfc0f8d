import random

from pyspark.sql import functions as F

from tidemark.operators import signatures as S
from tidemark.operators.inbox import signed
from tidemark.sources.staging import staged


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, event_id long, v string").repartition(3)


def test_changes_are_found_in_a_few_ranges_a_level(spark):
    rng = random.Random(3)
    ids = rng.sample(range(1 << 30), 3000)  # sparse: nearly every row is alone in its range of level 0 and 1
    rows = [(str(i % 4), i, "x") for i in ids]
    changed = [("0" if r[1] == ids[5] else r[0], r[1], "y" if r[1] in (ids[9], ids[17]) else "x") for r in rows if r[1] != ids[30]] + [("9", 12, "new")]
    levels = S.levels_for(*(frame(spark, t).select(F.col("event_id").alias("id")) for t in (rows, changed)))
    before, after = (staged(S.tree(frame(spark, t), "k", "event_id", F.col("v"), levels)) for t in (rows, changed))
    found, compared = S.differing(before, after, levels)
    expected = {(k, i) for k, i, _ in set(rows) ^ set(changed)}
    assert levels == 4 and {(r["k"], r["low"]) for r in found.collect()} == expected
    assert compared[0] == 5 and sum(compared[1:]) < 3000 and compared[-1] < 3000 / 10
    same, compared = S.differing(before, before, levels)
    assert same.isEmpty() and compared[1:] == [0] * levels


def test_signature_of_sparse_ids_goes_by_levels(spark):
    ids = [3, 4095, 4096, 5000, 1 << 24, (1 << 36) + 5]
    line = {"signature": F.col("v")}
    one = signed(frame(spark, [("a", i, f"v{i}") for i in ids]), "k", line, F.md5).collect()
    shuffled = signed(frame(spark, [("a", i, f"v{i}") for i in reversed(ids)]), "k", line, F.md5).collect()
    other = signed(frame(spark, [("a", i, f"v{i}" if i != 4096 else "w") for i in ids]), "k", line, F.md5).collect()
    assert one == shuffled and one[0]["n"] == 6 and one[0]["signature"] != other[0]["signature"]
