"""Keyed state as folds over ordered events.

A state machine is written once, as one expression per field over the state
``a`` and the event ``x``; the same text serves Spark's ``aggregate``, the
oracle's ``list_reduce`` and the streaming operator's rules. Events are folded
in arrival order (received_ms, event_id), not in business order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.plans.registry import query
from tidemark.sources.journal import HOUR, JOURNAL_SQL, NOW, journal

Machine = Mapping[str, tuple[str, str, str]]

#: An event is older than a state if its business time is less, or equal with a lesser version; nulls are never older.
OLDER = "coalesce(x.ms < a.last_ms OR (x.ms = a.last_ms AND x.ver < a.last_ver), false)"
OLDER_MOVE = "coalesce(x.ms < a.nft_ms OR (x.ms = a.nft_ms AND x.ver < a.nft_ver), false)"
TERMINAL = "('sold', 'cancelled', 'invalidated')"
COMPLETE_NEW = "x.ord IS NOT NULL AND x.nft IS NOT NULL AND x.seller IS NOT NULL AND x.price IS NOT NULL AND x.exp IS NOT NULL AND x.ms IS NOT NULL"
COMPLETE = "coalesce(x.seller, a.seller) IS NOT NULL AND coalesce(x.price, a.price) IS NOT NULL AND coalesce(x.exp, a.exp) IS NOT NULL"

#: What an event does to an order (rules in the order in which they are tried).
ORDER_ACTION = f"""CASE
 WHEN x.type = 'item_transferred' THEN CASE
   WHEN NOT a.here OR a.status <> 'active' OR NOT a.is_active OR coalesce(x.nft <> a.nft, true) THEN 'transfer_not_for_order'
   WHEN {OLDER_MOVE} THEN 'ignored_older_transfer' ELSE 'suppressed' END
 WHEN x.type = 'order_revalidate' THEN CASE WHEN a.here THEN 'revalidate' ELSE 'revalidate_missing' END
 WHEN x.type = 'item_listed' AND NOT a.here THEN CASE WHEN x.ord IS NULL OR x.nft IS NULL THEN 'unusable_listing' WHEN {COMPLETE_NEW} THEN 'inserted_active' ELSE 'inserted_unknown' END
 WHEN x.type = 'item_listed' AND a.status IN {TERMINAL} THEN 'ignored_terminal_listing'
 WHEN x.type = 'item_listed' THEN CASE WHEN {OLDER} THEN 'ignored_older_event' ELSE 'updated_listing' END
 WHEN NOT a.here AND x.type = 'order_invalidate' THEN CASE WHEN x.ord IS NULL OR x.nft IS NULL THEN 'ignored_invalid_invalidation' ELSE 'inserted_invalidation_tombstone' END
 WHEN NOT a.here THEN 'ignored_missing_order'
 WHEN x.type = 'order_invalidate' AND a.status IN ('sold', 'cancelled') THEN 'preserved_specific_terminal'
 WHEN (x.type = 'item_sold' AND a.status = 'cancelled') OR (x.type = 'item_cancelled' AND a.status = 'sold') THEN 'terminal_conflict'
 WHEN {OLDER} AND NOT (x.type = 'item_sold' AND a.status = 'invalidated') THEN 'ignored_older_event'
 WHEN x.type = 'item_cancelled' THEN 'applied_cancelled' WHEN x.type = 'item_sold' THEN 'applied_sold' ELSE 'applied_invalidated' END"""

WRITES = "c IN ('inserted_active', 'inserted_unknown', 'inserted_invalidation_tombstone', 'updated_listing', 'applied_cancelled', 'applied_sold', 'applied_invalidated')"
SUSPICIOUS = "x.suspicious"


def _taken(new: str, field: str) -> str:
    return f"CASE WHEN {WRITES} THEN coalesce({new}, a.{field}) ELSE a.{field} END"


#: field: (type, first value, next value given the action ``c``)
ORDER_MACHINE: Machine = {
    "here": ("boolean", "false", "a.here OR c IN ('inserted_active', 'inserted_unknown', 'inserted_invalidation_tombstone')"),
    "status": ("string", "NULL", f"CASE c WHEN 'inserted_active' THEN 'active' WHEN 'inserted_unknown' THEN 'unknown' WHEN 'updated_listing' THEN CASE WHEN {COMPLETE} THEN 'active' ELSE 'unknown' END WHEN 'inserted_invalidation_tombstone' THEN 'invalidated' WHEN 'applied_invalidated' THEN 'invalidated' WHEN 'applied_cancelled' THEN 'cancelled' WHEN 'applied_sold' THEN 'sold' ELSE a.status END"),
    "is_active": ("boolean", "false", f"CASE WHEN c = 'inserted_active' THEN true WHEN c = 'updated_listing' THEN ({COMPLETE}) AND NOT {SUSPICIOUS} WHEN {WRITES} OR c IN ('revalidate', 'suppressed') THEN false ELSE a.is_active END"),
    "needs": ("boolean", "false", f"CASE WHEN c = 'inserted_active' THEN {SUSPICIOUS} WHEN c = 'updated_listing' THEN NOT ({COMPLETE}) OR {SUSPICIOUS} WHEN c IN ('inserted_unknown', 'inserted_invalidation_tombstone', 'applied_invalidated', 'terminal_conflict', 'revalidate', 'suppressed') THEN true ELSE a.needs END"),
    "reason": ("string", "NULL", f"CASE c WHEN 'inserted_unknown' THEN 'listing_missing_critical_fields' WHEN 'updated_listing' THEN CASE WHEN NOT ({COMPLETE}) THEN 'listing_missing_critical_fields' WHEN {SUSPICIOUS} THEN x.issues END WHEN 'inserted_active' THEN NULL WHEN 'inserted_invalidation_tombstone' THEN 'invalidate_without_prior_listing' WHEN 'applied_invalidated' THEN 'order_invalidated' WHEN 'terminal_conflict' THEN 'terminal_event_conflict' WHEN 'revalidate' THEN 'order_revalidate_unverified' WHEN 'suppressed' THEN 'transfer_observed' ELSE a.reason END"),
    "last_type": ("string", "NULL", f"CASE WHEN {WRITES} THEN x.type ELSE a.last_type END"),
    "last_ms": ("bigint", "NULL", _taken("x.ms", "last_ms")),
    "last_ver": ("bigint", "NULL", _taken("x.ver", "last_ver")),
    "seller": ("string", "NULL", _taken("x.seller", "seller")),
    "price": ("string", "NULL", _taken("x.price", "price")),
    "exp": ("bigint", "NULL", _taken("x.exp", "exp")),
    "nft": ("string", "NULL", _taken("x.nft", "nft")),
    "nft_ms": ("bigint", "NULL", "CASE WHEN c = 'suppressed' THEN x.ms ELSE a.nft_ms END"),
    "nft_ver": ("bigint", "NULL", "CASE WHEN c = 'suppressed' THEN x.ver ELSE a.nft_ver END"),
    "ignored": ("int", "0", "a.ignored + CASE WHEN c LIKE 'ignored%' OR c IN ('preserved_specific_terminal', 'terminal_conflict', 'transfer_not_for_order', 'revalidate', 'revalidate_missing', 'unusable_listing') THEN 1 ELSE 0 END"),
    "outcome": ("string", "NULL", "c"),
}

ASSET_ACTION = "CASE WHEN x.nft IS NULL THEN 'ignored_malformed_transfer' WHEN a.here AND " + OLDER + " THEN 'ignored_older_transfer' WHEN a.here THEN 'updated' ELSE 'inserted' END"
APPLIED = "c IN ('inserted', 'updated')"
ASSET_MACHINE: Machine = {
    "here": ("boolean", "false", f"a.here OR {APPLIED}"),
    "owner": ("string", "NULL", f"CASE WHEN {APPLIED} THEN x.dst ELSE a.owner END"),
    "sender": ("string", "NULL", f"CASE WHEN {APPLIED} THEN x.src ELSE a.sender END"),
    "tx": ("string", "NULL", f"CASE WHEN {APPLIED} THEN x.tx ELSE a.tx END"),
    "last_ms": ("bigint", "NULL", f"CASE WHEN {APPLIED} THEN x.ms ELSE a.last_ms END"),
    "last_ver": ("bigint", "NULL", f"CASE WHEN {APPLIED} THEN x.ver ELSE a.last_ver END"),
    "updates": ("int", "0", f"a.updates + CASE WHEN {APPLIED} THEN 1 ELSE 0 END"),
    "effective": ("array<bigint>", "[]", f"CASE WHEN {APPLIED} THEN {{append}}(a.effective, x.id) ELSE a.effective END"),
}

#: Fields of an event for the order fold and for the asset fold, from journal columns.
ORDER_EVENT = {
    "at": "received_ms", "id": "event_id", "type": "event_type", "ms": "event_ms", "ver": "event_version", "ord": "order_hash", "nft": "nft_id", "seller": "seller",
    "price": "price_raw", "exp": "expiration_ms", "suspicious": "coalesce(k % 17 = 5, false)", "issues": "CASE WHEN k % 17 = 5 THEN 'mapping_issue' END",
}
ASSET_EVENT = {"at": "received_ms", "id": "event_id", "nft": "nft_id", "ms": "event_ms", "ver": "event_version", "src": "from_address", "dst": "to_address", "tx": "transaction_hash"}


def spark_fold(machine: Machine, action: str, events: str, first: str | None = None) -> str:
    """Spark SQL for the state after all events of the array ``events`` (sorted by its first fields), from the state ``first`` or the empty one."""
    begin = {n: f"{first}.{n}" if first else "array()" if v == "[]" else v for n, (_, v, _) in machine.items()}
    held = ", ".join(f"'{n}', CAST({begin[n]} AS {t})" for n, (t, _, _) in machine.items())
    step = ", ".join(f"'{n}', CAST({e.replace('{append}', 'array_append')} AS {t})" for n, (t, _, e) in machine.items())
    return f"aggregate({events}, named_struct({held}), (a, x) -> element_at(transform(array({action}), c -> named_struct({step})), 1))"


_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "array<bigint>": "BIGINT[]"}


def duck_fold(machine: Machine, action: str, events: str, fields: Mapping[str, str]) -> str:
    """The oracle's form: states and events are one kind of struct, as its reduce wants it."""
    kind = lambda t: _DUCK_TYPES.get(t, t.upper())
    first = ", ".join(f"'{n}': CAST({v} AS {kind(t)})" for n, (t, v, _) in machine.items())
    step = ", ".join(f"'{n}': CAST({e.replace('{append}', 'list_append')} AS {kind(t)})" for n, (t, _, e) in machine.items())
    empty = f"{{s: {{{first}}}, e: NULL}}"
    step = step.replace("a.", "q.s.").replace("x.", "p.e.")
    act = action.replace("a.", "q.s.").replace("x.", "p.e.")
    event = ", ".join(f"'{n}': {c}" for n, c in fields.items())
    items = f"list({{s: NULL, e: {{{event}}}}} ORDER BY received_ms, event_id)"
    return f"list_reduce({events or items}, lambda q, p: list_transform([{act}], lambda c: {{s: {{{step}}}, e: p.e}})[1], {empty})"


def ordered_events(rows: DataFrame, key: str, fields: Mapping[str, str]) -> DataFrame:
    """(key, events): the events of each key in arrival order.

    A fold is sequential by nature, so the events of one key meet in one task;
    other keys do not wait for it. Long histories are cut by folding from a
    stored state (``replay``) or by the streaming form, which keeps the state.
    """
    event = F.struct(*(F.expr(e).alias(n) for n, e in fields.items()))
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(event)).alias("events"))


def fold(rows: DataFrame, key: str, fields: Mapping[str, str], machine: Machine, action: str) -> DataFrame:
    """(key, fields of the state) after folding all events."""
    folded = ordered_events(rows, key, fields).select(key, F.expr(spark_fold(machine, action, "events")).alias("s"))
    return folded.select(key, "s.*")


ASSET_SQL = JOURNAL_SQL + ", folded AS (SELECT token_id, " + duck_fold(ASSET_MACHINE, ASSET_ACTION, "", ASSET_EVENT) + """.s AS s
FROM j WHERE event_type = 'item_transferred' GROUP BY token_id)
"""


def asset_states(rows: DataFrame) -> DataFrame:
    return fold(rows.where("event_type = 'item_transferred'"), "token_id", ASSET_EVENT, ASSET_MACHINE, ASSET_ACTION)


@query("asset_owner_fold", ASSET_SQL + "SELECT token_id, s.owner AS owner, s.sender AS sender, s.tx AS tx, s.last_ms AS last_ms, s.updates AS updates, len(s.effective) AS effective FROM folded")
def asset_owner_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asset_states(journal(spark, sf_dir)).select("token_id", "owner", "sender", "tx", "last_ms", "updates", F.size("effective").alias("effective"))


STATE_COLUMNS = ("status", "is_active", "needs", "reason", "last_type", "last_ms", "last_ver", "seller", "price", "exp", "nft", "ignored", "outcome")
_STATE_SQL = ", ".join(f"s.{c} AS {c}" for c in STATE_COLUMNS)


@query("order_state_fold", JOURNAL_SQL + ", folded AS (SELECT order_hash, " + duck_fold(ORDER_MACHINE, ORDER_ACTION, "", ORDER_EVENT) + f""".s AS s
FROM j WHERE order_hash IS NOT NULL GROUP BY order_hash)
SELECT order_hash, {_STATE_SQL} FROM folded WHERE s.here""")
def order_state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_states(journal(spark, sf_dir).where("order_hash IS NOT NULL")).select("order_hash", *STATE_COLUMNS)


def order_states(rows: DataFrame) -> DataFrame:
    return fold(rows, "order_hash", ORDER_EVENT, ORDER_MACHINE, ORDER_ACTION).where("here")


def with_transfers(rows: DataFrame) -> DataFrame:
    """Order events, and the effective transfers of every asset that the order ever named.

    Transfers act on orders, but no order acts on an asset. So the assets are
    folded first; the transfers that they did not ignore are joined to the
    orders, and each order is folded once over both kinds.
    """
    own = rows.where("order_hash IS NOT NULL")
    effective = asset_states(rows).select(F.explode("effective").alias("event_id"))
    moves = rows.where("event_type = 'item_transferred'").join(effective, "event_id", "left_semi").drop("order_hash")
    named = own.select("nft_id", "order_hash").distinct()
    return own.unionByName(moves.join(named, "nft_id").select(*own.columns))


@query("order_state_with_transfers", ASSET_SQL + """, moved AS (SELECT unnest(s.effective) AS event_id FROM folded),
all_events AS (SELECT j.* FROM j WHERE order_hash IS NOT NULL
  UNION ALL SELECT j.* REPLACE (n.order_hash AS order_hash) FROM j JOIN moved USING (event_id) JOIN (SELECT DISTINCT nft_id, order_hash FROM j WHERE order_hash IS NOT NULL) n ON j.nft_id = n.nft_id),
orders_folded AS (SELECT order_hash, """ + duck_fold(ORDER_MACHINE, ORDER_ACTION, "", ORDER_EVENT) + f""".s AS s FROM all_events GROUP BY order_hash)
SELECT order_hash, {_STATE_SQL}, s.nft_ms AS nft_ms FROM orders_folded WHERE s.here""")
def order_state_with_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_states(with_transfers(journal(spark, sf_dir))).select("order_hash", *STATE_COLUMNS, "nft_ms")


@query("apply_outcomes", JOURNAL_SQL + ", folded AS (SELECT order_hash, " + duck_fold(ORDER_MACHINE, ORDER_ACTION, "", ORDER_EVENT) + """.s AS s FROM j WHERE order_hash IS NOT NULL GROUP BY order_hash)
SELECT CASE WHEN s.outcome LIKE '%ignored_older%' THEN 'ignored_older' WHEN s.needs THEN 'reconciliation_required' ELSE 'applied' END AS final_status, s.outcome AS outcome, count(*) AS n FROM folded GROUP BY ALL""")
def apply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = fold(journal(spark, sf_dir).where("order_hash IS NOT NULL"), "order_hash", ORDER_EVENT, ORDER_MACHINE, ORDER_ACTION)
    final = F.when(F.col("outcome").contains("ignored_older"), "ignored_older").when(F.col("needs"), "reconciliation_required").otherwise("applied")
    return states.groupBy(final.alias("final_status"), "outcome").agg(F.count(F.lit(1)).alias("n"))


#: The fence, in arrival time, and the end of the snapshot that was taken behind it.
FENCE = NOW - 10 * 24 * HOUR
SNAPSHOT_END = FENCE + 2 * HOUR
#: Events behind the fence, some of which lack a business time or were not settled.
LATER_EVENT = {"event_ms": "CASE WHEN event_id % 53 = 3 THEN NULL ELSE event_ms END", "processing_status": "CASE WHEN event_id % 7 IN (0, 1, 4) AND event_id % 29 <> 0 THEN 'applied' ELSE processing_status END"}
#: What forbids to replay an order's events, tried from the top.
REPLAY_PROBLEMS: R.Rules = (("POST_STABLE_EVENT_UNSAFE_STATUS", "unsafe"), ("POST_STABLE_EVENT_TIME_MISSING", "timeless"))
_SETTLED = "processing_status IN ('applied', 'reconciliation_required')"
_PASSED_OVER = "processing_status IN ('ignored_duplicate', 'ignored_older')"


@query("replay_after_fence", JOURNAL_SQL + f""", later AS (SELECT * FROM (SELECT * REPLACE ({', '.join(f'{e} AS {n}' for n, e in LATER_EVENT.items())}) FROM j WHERE order_hash IS NOT NULL AND received_ms > {FENCE}) WHERE NOT {_PASSED_OVER}),
baseline AS (SELECT DISTINCT order_hash FROM j WHERE event_type = 'item_listed' AND received_ms <= {FENCE}),
flagged AS (SELECT order_hash, bool_or(NOT {_SETTLED}) AS unsafe, bool_or(event_ms IS NULL) AS timeless FROM later GROUP BY order_hash),
folded AS (SELECT order_hash, """ + duck_fold(ORDER_MACHINE, ORDER_ACTION, "", ORDER_EVENT) + f""".s AS s, count(*) AS replayed FROM later JOIN baseline USING (order_hash) WHERE event_ms > {SNAPSHOT_END} GROUP BY order_hash),
joined AS (SELECT b.order_hash, coalesce(unsafe, false) AS unsafe, coalesce(timeless, false) AS timeless, s, replayed FROM baseline b LEFT JOIN flagged USING (order_hash) LEFT JOIN folded USING (order_hash)),
told AS (SELECT *, {R.first_text(REPLAY_PROBLEMS, None)} AS problem FROM joined)
SELECT order_hash, problem, CASE WHEN problem IS NULL THEN coalesce(s.status, 'none') END AS status, CASE WHEN problem IS NULL THEN coalesce(s.is_active, false) END AS is_active, CASE WHEN problem IS NULL THEN coalesce(replayed, 0) ELSE 0 END AS replayed FROM told""")
def replay_after_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journal(spark, sf_dir).where("order_hash IS NOT NULL")
    base = rows.where((F.col("event_type") == "item_listed") & (F.col("received_ms") <= FENCE)).select("order_hash").distinct()
    return replay(base, rows.where(F.col("received_ms") > FENCE).withColumns({n: R.expression(e) for n, e in LATER_EVENT.items()}), SNAPSHOT_END)


def replay(baseline: DataFrame, events: DataFrame, snapshot_end: int) -> DataFrame:
    """(order_hash, problem, status, is_active, replayed): orders of a baseline after the events behind its fence.

    Ignored events are passed over. An order with an event that is not settled,
    or has no business time, is not replayed; else those whose business time
    is after the snapshot are folded.
    """
    later = events.where(f"NOT {_PASSED_OVER}").join(baseline, "order_hash", "left_semi")
    flags = later.groupBy("order_hash").agg(F.bool_or(R.expression(f"NOT {_SETTLED}")).alias("unsafe"), F.bool_or(F.col("event_ms").isNull()).alias("timeless"))
    grouped = ordered_events(later.where(F.col("event_ms") > snapshot_end), "order_hash", ORDER_EVENT)
    folded = grouped.select("order_hash", F.expr(spark_fold(ORDER_MACHINE, ORDER_ACTION, "events")).alias("s"), F.size("events").cast("long").alias("count"))
    told = baseline.join(flags, "order_hash", "left").join(folded, "order_hash", "left").withColumn("problem", R.first(REPLAY_PROBLEMS, None))
    good = F.col("problem").isNull()
    return told.select(
        "order_hash", "problem", F.when(good, F.coalesce("s.status", F.lit("none"))).alias("status"), F.when(good, F.coalesce("s.is_active", F.lit(False))).alias("is_active"), F.when(good, F.coalesce("count", F.lit(0))).otherwise(0).cast("long").alias("replayed")
    )
