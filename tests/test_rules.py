"""The order rules: stated cases, and the batch fold against the rules on random histories."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.order_rules import FIELDS, empty, reduce_order
from tidemark.operators.folds import ASSET_ACTION, ASSET_MACHINE, ORDER_ACTION, ORDER_MACHINE, spark_fold

EVENT = "at bigint, id bigint, type string, ms bigint, ver bigint, ord string, nft string, seller string, price string, exp bigint, suspicious boolean, issues string"


def event(kind, ms=10, ver=1, **changes):
    full = {"at": 0, "id": 0, "type": kind, "ms": ms, "ver": ver, "ord": "o", "nft": "n", "seller": "s", "price": "1.0", "exp": 99, "suspicious": False, "issues": None}
    return {**full, **changes}


def after(*events):
    state = empty()
    for e in events:
        state = reduce_order(state, e)
    return state


@pytest.mark.parametrize(
    ("events", "status", "active", "needs", "outcome"),
    [
        ([event("item_listed")], "active", True, False, "inserted_active"),
        ([event("item_listed", suspicious=True, issues="x")], "active", True, True, "inserted_active"),
        ([event("item_listed", price=None)], "unknown", False, True, "inserted_unknown"),
        ([event("item_listed"), event("item_listed", ms=20, suspicious=True, issues="x")], "active", False, True, "updated_listing"),
        ([event("item_listed"), event("item_listed", ms=5)], "active", True, False, "ignored_older_event"),
        ([event("item_listed", ver=None), event("item_listed", ver=0, ms=10)], "active", True, False, "updated_listing"),
        ([event("item_listed"), event("item_sold", ms=20), event("item_listed", ms=30)], "sold", False, False, "ignored_terminal_listing"),
        ([event("order_invalidate")], "invalidated", False, True, "inserted_invalidation_tombstone"),
        ([event("order_invalidate", ms=20), event("item_sold", ms=5)], "sold", False, True, "applied_sold"),
        ([event("item_listed"), event("item_sold", ms=20), event("item_cancelled", ms=30)], "sold", False, True, "terminal_conflict"),
        ([event("item_listed"), event("item_sold", ms=20), event("order_invalidate", ms=30)], "sold", False, False, "preserved_specific_terminal"),
        ([event("item_listed"), event("order_revalidate", ms=20)], "active", False, True, "revalidate"),
        ([event("item_listed"), event("item_transferred", ms=20)], "active", False, True, "suppressed"),
        ([event("item_listed"), event("item_transferred", nft="m")], "active", True, False, "transfer_not_for_order"),
        ([event("item_sold")], None, False, False, "ignored_missing_order"),
        ([event("item_listed", nft=None)], None, False, False, "unusable_listing"),
    ],
)
def test_stated_cases(events, status, active, needs, outcome):
    state = after(*events)
    assert (state["status"], state["is_active"], state["needs"], state["outcome"]) == (status, active, needs, outcome)


def test_fold_follows_the_rules_on_random_histories(spark):
    rng = random.Random(4)
    kinds = ["item_listed", "item_sold", "item_cancelled", "order_invalidate", "order_revalidate", "item_transferred"]
    maybe = lambda x: None if rng.random() < 0.2 else x
    histories = []
    for _ in range(400):
        made = [
            event(rng.choice(kinds), maybe(rng.randint(1, 4)), maybe(rng.randint(1, 3)), at=i, id=i, ord=maybe("o"), nft=maybe(rng.choice("nm")), seller=maybe("s"), price=maybe("1"), exp=maybe(9), suspicious=rng.random() < 0.2, issues="i")
            for i in range(rng.randint(1, 9))
        ]
        histories.append(made)
    rows = spark.createDataFrame([(i, [tuple(e.values()) for e in h]) for i, h in enumerate(histories)], f"i int, events array<struct<{EVENT.replace(' ', ':').replace(',:', ',')}>>")
    found = {r["i"]: r["s"] for r in rows.select("i", F.expr(spark_fold(ORDER_MACHINE, ORDER_ACTION, "events")).alias("s")).collect()}
    for i, h in enumerate(histories):
        expected = after(*h)
        assert {n: found[i][n] for n in FIELDS} == expected, h


def test_asset_fold_ties_go_to_the_later_arrival(spark):
    kind = "array<struct<at:bigint,id:bigint,nft:string,ms:bigint,ver:bigint,src:string,dst:string,tx:string>>"
    moves = [(0, 1, "n", 10, 1, "a", "b", "t1"), (1, 2, "n", 10, None, "b", "c", "t2"), (2, 3, "n", 9, 9, "c", "d", "t3"), (3, 4, None, 99, 9, "c", "e", "t4")]
    rows = spark.createDataFrame([(moves,)], f"events {kind}")
    s = rows.select(F.expr(spark_fold(ASSET_MACHINE, ASSET_ACTION, "events")).alias("s")).first()["s"]
    assert (s["owner"], s["tx"], s["updates"], s["effective"]) == ("c", "t2", 2, [1, 2])
