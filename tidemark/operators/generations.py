"""Generations of snapshots: candidates, transport accounts, catch-up rounds, fences and baselines.

Rules are functions of evidence columns; the queries' evidence is derived from
``orders`` (sweeps) and ``lineitem`` (rounds), and from the journal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.operators.joins import LATEST_SQL, latest_orders
from tidemark.plans.registry import query
from tidemark.sources.journal import FAMILIES, HOUR, NOW, STATUSES, journal, read

BASELINE = NOW - 15 * 24 * HOUR
_TYPES = ", ".join(f"'{t}'" for t in (*FAMILIES.values(), "order_revalidate"))
_KNOWN = ", ".join(f"'{s}'" for s in STATUSES)

#: What a local order's own columns, and the manifest of the snapshot that should show it, say against it.
ORDER_REASONS: R.Rules = (
    ("SNAPSHOT_NOT_COMPLETE", "manifest IS NULL OR manifest LIKE '%SNAPSHOT_NOT_COMPLETE%'"), ("SNAPSHOT_SEMANTICALLY_UNSAFE", "manifest LIKE '%SNAPSHOT_SEMANTICALLY_UNSAFE%'"),
    ("IDENTITY_AMBIGUOUS", "copies > 1 OR seen_copies > 1 OR identities > 1 OR order_hash = ''"),
    ("INVALID_LOCAL_IDENTITY", "identity_status = 'INVALID_LOCAL_IDENTITY' OR (identity_status = 'VALID' AND identity_hash <> order_hash)"), ("UNSUPPORTED_LOCAL_SCOPE", "identity_status = 'UNSUPPORTED_LOCAL_SCOPE'"),
    ("ORDER_NOT_ACTIVE", "status <> 'active' OR NOT is_active"), ("NEEDS_RECONCILIATION", "needs_reconciliation"),
    ("ORDER_CREATED_OR_UPDATED_AFTER_BASELINE", f"created_ms > {BASELINE} OR updated_ms > {BASELINE}"),
)
_NEWER = "(event_ms > last_ms OR (event_ms = last_ms AND event_version > last_version))"
_UNORDERED = "(event_ms IS NULL OR last_ms IS NULL OR (event_ms = last_ms AND (event_version IS NULL OR last_version IS NULL)))"
#: What one event of an order says against it; the baseline is the start of the snapshot.
EVENT_REASONS: R.Rules = (
    ("UNKNOWN_EVENT_TYPE", f"event_type IS NULL OR event_type NOT IN ({_TYPES})"), ("UNKNOWN_PROCESSING_STATUS", f"processing_status IS NULL OR processing_status NOT IN ({_KNOWN})"),
    ("PENDING_EVENT", "processing_status = 'pending'"), ("PROCESSING_EVENT", "processing_status = 'processing'"), ("FAILED_EVENT", "processing_status = 'failed'"), ("UNRESOLVED_EVENT", "processing_status = 'reconciliation_required' OR unresolved"),
    ("EVENT_ORDERING_AMBIGUOUS", f"ambiguous OR ({_UNORDERED} AND (event_ms IS NOT NULL OR event_version IS NOT NULL))"), ("NEWER_EVENT_AFTER_BASELINE", f"received_ms > {BASELINE}"), ("REVALIDATE_UNVERIFIED", "event_type = 'order_revalidate'"),
    ("TERMINAL_EVENT_PRESENT", f"{_NEWER} AND event_type IN ('item_sold', 'item_cancelled', 'order_invalidate')"),
)
CLASSES: R.Rules = (("BLOCKED", "reasons <> ''"), ("PRESENT", "is_seen"))

#: A sweep's account of its transport, its provenance and its barriers.
SWEEP = {
    "sweep_id": "o_orderkey", "started_ms": f"{NOW} + o_custkey % 50", "completed_ms": f"{NOW} + o_custkey % 50 + CASE WHEN o_orderkey % 41 = 1 THEN -1 ELSE 60 END", "sources": "CASE WHEN o_orderkey % 43 = 1 THEN 0 ELSE 2 END",
    "initial_state": "CASE WHEN o_orderkey % 47 = 1 THEN 'VERIFIED' WHEN o_orderkey % 53 = 2 THEN 'PAUSED' ELSE 'OPEN' END", "transport": "CASE o_custkey % 23 WHEN 1 THEN 'PARTIAL' WHEN 2 THEN 'FAILED' WHEN 3 THEN 'LOST' ELSE 'COMPLETE' END",
    "exhausted": "o_orderkey % 59 <> 3", "truncated": "o_orderkey % 61 = 4", "malformed": "CASE WHEN o_custkey % 37 = 4 THEN 2 ELSE 0 END", "conflicts": "CASE WHEN o_custkey % 43 = 5 THEN 1 ELSE 0 END", "cycle": "o_orderkey % 67 = 5", "warnings": "CASE WHEN o_custkey % 47 = 6 THEN 1 ELSE 0 END",
    "page_attempts": "8", "pages": "7", "http_attempts": "9", "retries": "CASE WHEN o_orderkey % 71 = 6 THEN 2 ELSE 1 END", "raw_pages": "CASE WHEN o_custkey % 53 = 7 THEN 6 ELSE 7 END", "hashes": "7", "observed": "o_custkey % 900", "normalised": "CASE WHEN o_custkey % 59 = 8 THEN 0 ELSE o_custkey % 900 END",
    "details": "8", "successful": "7", "before_ms": f"CAST({NOW} AS BIGINT)", "before_id": "o_orderkey % 10", "after_ms": f"CAST({NOW} AS BIGINT)", "after_id": "o_orderkey % 10 + CASE WHEN o_custkey % 61 = 9 THEN -20 ELSE 0 END", "budget": "CASE WHEN o_orderkey % 73 = 7 THEN 1 ELSE 5 END",
}
_SPAN = "(completed_ms IS NULL OR started_ms IS NULL OR completed_ms < started_ms OR sources = 0)"
#: What keeps a snapshot's manifest from candidates.
MANIFEST: R.Rules = (
    ("SNAPSHOT_NOT_COMPLETE", f"transport <> 'COMPLETE' OR generation <> 'TRANSPORT_COMPLETE' OR NOT exhausted OR truncated OR malformed <> 0 OR conflicts <> 0 OR cycle OR {_SPAN}"),
    ("SNAPSHOT_SEMANTICALLY_UNSAFE", "malformed <> 0 OR conflicts <> 0 OR cycle OR malformed IS NULL OR conflicts IS NULL"),
)
GENERATION = "CASE WHEN o_orderkey % 97 = 3 THEN 'OPEN' ELSE 'TRANSPORT_COMPLETE' END"

#: Local orders and their identities, derived from the latest state of the journal.
LOCAL = {
    "order_hash": "order_hash", "identity_hash": "CASE WHEN n_events % 61 = 60 THEN 'other' ELSE order_hash END", "status": "CASE WHEN last_type = 'item_listed' OR n_events % 3 <> 0 THEN 'active' ELSE 'sold' END",
    "is_active": "n_events % 7 <> 6", "needs_reconciliation": "n_events % 11 = 10", "created_ms": f"CAST({BASELINE} AS BIGINT) - 1", "updated_ms": f"CASE WHEN n_events % 13 = 12 THEN CAST({BASELINE} AS BIGINT) + 1 ELSE CAST({BASELINE} AS BIGINT) END",
    "last_ms": f"CASE WHEN n_events % 5 = 0 THEN {BASELINE} - {10 * 24 * HOUR} ELSE {BASELINE} + {40 * 24 * HOUR} END", "last_version": "CAST(n_events AS BIGINT)",
    "identity_status": "CASE WHEN n_events % 17 = 16 THEN 'UNSUPPORTED_LOCAL_SCOPE' WHEN n_events % 19 = 18 THEN 'INVALID_LOCAL_IDENTITY' ELSE 'VALID' END", "copy": "n_events % 23",
    "sweep_id": "CAST(split_part(order_hash, '-', 1) AS BIGINT)",
}
EVENT = {
    "order_hash": "order_hash", "event_type": "CASE WHEN event_id % 431 = 5 THEN 'order_revalidate' WHEN event_id % 433 = 7 THEN 'item_minted' ELSE event_type END",
    "processing_status": "CASE WHEN event_id % 397 = 3 THEN 'paused' WHEN event_id % 401 = 4 THEN 'pending' WHEN event_id % 409 = 5 THEN 'processing' WHEN event_id % 419 = 6 THEN 'failed' WHEN event_id % 421 = 7 THEN 'reconciliation_required' WHEN event_id % 7 < 5 THEN 'applied' ELSE processing_status END",
    "event_ms": "event_ms", "event_version": "event_version", "received_ms": f"received_ms - {25 * 24 * HOUR}", "unresolved": "event_id % 439 = 2", "ambiguous": "event_id % 443 = 1",
}
#: Entries of the snapshot for an order with ``n`` listings: none, one, or by mistake two.
ENTRIES = "CASE WHEN n % 4 = 0 THEN 0 WHEN n % 11 = 5 THEN 2 ELSE 1 END"
CLASSIFIED_SQL = LATEST_SQL + f""", once AS (SELECT {', '.join(f'{R.text_of(e)} AS {n}' for n, e in LOCAL.items())} FROM latest),
local AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE copy = 22),
listed AS (SELECT order_hash, count(*) AS n FROM j WHERE event_type = 'item_listed' AND seller IS NOT NULL AND received_ms <= {BASELINE + 10 * 24 * HOUR} GROUP BY order_hash),
seen AS (SELECT order_hash, {ENTRIES} AS seen_copies FROM listed WHERE {ENTRIES} > 0),
e AS (SELECT {', '.join(f'{R.text_of(x)} AS {n}' for n, x in EVENT.items())} FROM j WHERE order_hash IS NOT NULL),
manifests AS (SELECT sweep_id, {R.reasons_text(MANIFEST)} AS manifest FROM ({R.derived_text('orders', {**SWEEP, 'generation': GENERATION})})),
keys AS (SELECT order_hash, count(*) AS copies, count(DISTINCT CASE WHEN identity_status = 'VALID' THEN identity_hash END) AS identities, min(last_ms) AS last_ms, min(last_version) AS last_version FROM local GROUP BY order_hash),
per_event AS (SELECT order_hash, {', '.join(f'coalesce(bool_or({R.text_of(c)}), false) AS {n.lower()}' for n, c in EVENT_REASONS)} FROM e JOIN keys USING (order_hash) GROUP BY order_hash),
whole AS (SELECT l.*, k.copies, k.identities, coalesce(s.seen_copies, 0) AS seen_copies, s.seen_copies IS NOT NULL AS is_seen, p.* EXCLUDE (order_hash) FROM local l JOIN keys k USING (order_hash) LEFT JOIN seen s USING (order_hash) LEFT JOIN per_event p USING (order_hash)),
attached AS (SELECT w.*, m.manifest FROM whole w LEFT JOIN manifests m USING (sweep_id)),
reasoned AS (SELECT order_hash, is_seen, {R.reasons_text((*ORDER_REASONS, *((n, n.lower()) for n, _ in EVENT_REASONS)))} AS reasons FROM attached),
classified AS (SELECT order_hash, is_seen AS seen, reasons, {R.first_text(CLASSES, 'ABSENT_CANDIDATE')} AS class FROM reasoned)"""


def classify_candidates(local: DataFrame, seen: DataFrame, events: DataFrame, manifests: DataFrame) -> DataFrame:
    """(order_hash, seen, reasons, class) of every local order against the snapshot of its sweep.

    Any reason blocks: of the snapshot's manifest (sweep_id, manifest: reasons;
    a sweep without one is not complete), of the order, of its identity
    (repeated orders and entries of the snapshot are ambiguous), or of any
    event of its journal.
    Events are reduced to flags of each order before they meet it again.
    """
    identity = F.when(F.col("identity_status") == "VALID", F.col("identity_hash"))
    keys = local.groupBy("order_hash").agg(F.count(F.lit(1)).alias("copies"), F.count_distinct(identity).alias("identities"), F.min("last_ms").alias("last_ms"), F.min("last_version").alias("last_version"))
    flags = events.join(keys.select("order_hash", "last_ms", "last_version"), "order_hash").groupBy("order_hash").agg(*(F.bool_or(R.expression(c)).alias(n.lower()) for n, c in EVENT_REASONS))
    entries = seen.groupBy("order_hash").agg(F.count(F.lit(1)).alias("seen_copies"))
    whole = local.join(keys.select("order_hash", "copies", "identities"), "order_hash").join(entries, "order_hash", "left").join(flags, "order_hash", "left")
    whole = whole.join(manifests, "sweep_id", "left").withColumn("is_seen", F.col("seen_copies").isNotNull()).withColumn("seen_copies", F.coalesce("seen_copies", F.lit(0)))
    reasoned = whole.select("order_hash", "is_seen", R.reasons((*ORDER_REASONS, *((n, n.lower()) for n, _ in EVENT_REASONS))).alias("reasons"))
    return reasoned.select("order_hash", F.col("is_seen").alias("seen"), "reasons", R.first(CLASSES, "ABSENT_CANDIDATE").alias("class"))


@query("snapshot_presence", CLASSIFIED_SQL + " SELECT * FROM classified")
def snapshot_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local orders against a complete snapshot: present, absent, or blocked by what is known of them."""
    rows = journal(spark, sf_dir)
    once = R.derived(latest_orders(rows), LOCAL)
    local = once.unionAll(once.where("copy = 22"))
    listed = rows.where((F.col("event_type") == "item_listed") & F.col("seller").isNotNull() & (F.col("received_ms") <= BASELINE + 10 * 24 * HOUR)).groupBy("order_hash").agg(F.count(F.lit(1)).alias("n"))
    seen = listed.select("order_hash", F.explode(F.array_repeat(F.lit(True), F.expr(ENTRIES)))).select("order_hash")
    manifests = R.derived(read(spark, sf_dir, "orders"), {**SWEEP, "generation": GENERATION}).select("sweep_id", R.reasons(MANIFEST).alias("manifest"))
    return classify_candidates(local, seen, R.derived(rows.where("order_hash IS NOT NULL"), EVENT), manifests)


#: What is wrong with one classified order.
BUNDLE_PROBLEMS: R.Rules = (
    ("INVALID_CANDIDATE_BUNDLE", "class NOT IN ('PRESENT', 'ABSENT_CANDIDATE', 'BLOCKED') OR (class = 'BLOCKED') = (reasons = '') OR (class = 'PRESENT' AND NOT seen) OR (class = 'ABSENT_CANDIDATE' AND seen)"),
    ("INVALID_CANDIDATE_IDENTITY", "order_hash IS NULL OR order_hash <> lower(order_hash)"), ("IDENTITY_AMBIGUOUS", "copies > 1"),
)


@query("bundle_validation", CLASSIFIED_SQL + f""", altered AS (SELECT order_hash, seen, CASE WHEN length(order_hash) % 4 = 3 AND reasons = 'NEEDS_RECONCILIATION' THEN '' ELSE reasons END AS reasons, class, count(*) OVER (PARTITION BY order_hash) AS copies FROM classified),
told AS (SELECT class, {R.reasons_text(BUNDLE_PROBLEMS)} AS problems FROM altered)
SELECT class, problems, count(*) AS n FROM told GROUP BY ALL""")
def bundle_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each class by what is wrong with them (reasons of some were lost, by the rule of the SQL)."""
    lost = (F.length("order_hash") % 4 == 3) & (F.col("reasons") == "NEEDS_RECONCILIATION")
    bundle = snapshot_presence(spark, sf_dir).withColumn("reasons", F.when(lost, "").otherwise(F.col("reasons")))
    return bundle_problems(bundle).groupBy("class", "problems").agg(F.count(F.lit(1)).alias("n"))


def bundle_problems(bundle: DataFrame) -> DataFrame:
    """The bundle's rows with problems, empty where a row is sound."""
    copies = bundle.groupBy("order_hash").agg(F.count(F.lit(1)).alias("copies"))
    return bundle.join(copies, "order_hash").withColumn("problems", R.reasons(BUNDLE_PROBLEMS)).drop("copies")


#: Rounds that watch the journal until it stands still.
ROUND = {
    "sweep_id": "l_orderkey", "round": "l_linenumber", "order_by": "l_partkey", "seen_ms": f"CAST({NOW} AS BIGINT)", "seen_id": "l_orderkey % 10 + CASE WHEN l_partkey % 89 = 1 THEN -30 ELSE 0 END", "pending": "CASE WHEN l_suppkey % 31 = 1 AND l_partkey % 3 = 0 THEN 1 ELSE 0 END", "processing": "CASE WHEN l_partkey % 71 = 2 THEN 1 ELSE 0 END",
    "failed": "CASE WHEN l_partkey % 73 = 3 THEN 1 ELSE 0 END", "unresolved": "CASE WHEN l_partkey % 79 = 4 THEN 1 ELSE 0 END", "unknown": "CASE WHEN l_partkey % 83 = 5 THEN 1 ELSE 0 END",
}
TRANSPORT: R.Rules = (
    ("SNAPSHOT_NOT_COMPLETE", f"transport <> 'COMPLETE' OR NOT exhausted OR truncated OR {_SPAN}"), ("SNAPSHOT_SEMANTICALLY_UNSAFE", "malformed <> 0 OR conflicts <> 0 OR cycle OR warnings > 0"),
    ("COUNTER_INCONSISTENT", "least(page_attempts, pages, http_attempts, retries, raw_pages, hashes, observed, normalised, details, successful) < 0 OR pages <> raw_pages OR pages <> hashes OR normalised <> observed OR retries <> http_attempts - page_attempts OR details <> page_attempts OR successful <> pages OR http_attempts < page_attempts OR pages > page_attempts"),
)
SWEEP_REASONS: R.Rules = (
    *TRANSPORT, ("INVALID_PROVENANCE", "sources = 0"), ("INVALID_INITIAL_STATE", "initial_state IN ('TRANSPORT_COMPLETE', 'CATCHING_UP', 'VERIFIED', 'ABORTED')"), ("UNKNOWN_GENERATION_STATE", "initial_state NOT IN ('OPEN', 'TRANSPORT_COMPLETE', 'CATCHING_UP', 'VERIFIED', 'ABORTED')"),
    ("INVALID_START_BARRIER", "completed_ms IS NULL OR started_ms IS NULL OR completed_ms < started_ms"), ("UNKNOWN_TRANSPORT_RESULT", "transport NOT IN ('COMPLETE', 'PARTIAL', 'FAILED', 'UNSAFE')"),
    ("WATERMARK_REGRESSION", f"{R.later('before', 'after')} OR regressed"), ("CATCH_UP_BUDGET_EXHAUSTED", "budget < 2 OR (catch_up = 'BUDGET_EXHAUSTED')"),
    ("PENDING_EVENTS_AT_BARRIER", "any_pending"), ("PROCESSING_EVENTS_AT_BARRIER", "any_processing"), ("FAILED_EVENTS_AT_BARRIER", "any_failed"), ("RECONCILIATION_REQUIRED_AT_BARRIER", "any_unresolved"), ("UNKNOWN_EVENT_STATE_AT_BARRIER", "any_unknown"),
)
_OPEN = ("pending", "processing", "failed", "unresolved", "unknown")
CATCH_UP: R.Rules = (
    ("UNSAFE", f"regressed OR {' OR '.join(f'any_{c}' for c in _OPEN)} OR {R.later('before', 'after')}"), ("STABLE", "stable_round IS NOT NULL"), ("BUDGET_EXHAUSTED", "rounds >= greatest(budget, 2)"),
)
GENERATION_STATES: R.Rules = (("ABORTED", "abort_reasons <> '' OR catch_up <> 'STABLE'"),)
_FLAGS = [f"any_{c}" for c in _OPEN]

GENERATION_SQL = f"""WITH s AS ({R.derived_text('orders', SWEEP)}), r AS ({R.derived_text('lineitem', ROUND)}),
ranked AS (SELECT r.*, row_number() OVER w AS place, lag(seen_ms) OVER w AS last_ms, lag(seen_id) OVER w AS last_id FROM r WINDOW w AS (PARTITION BY sweep_id ORDER BY round, order_by, seen_id, pending, processing, failed, unresolved, unknown)),
watched AS (SELECT s.sweep_id, place, seen_ms, seen_id, coalesce(last_ms, before_ms) AS from_ms, coalesce(last_id, before_id) AS from_id, {', '.join(_OPEN)} FROM ranked JOIN s USING (sweep_id) WHERE place <= greatest(budget, 2)),
per AS (SELECT sweep_id, bool_or({R.later('from', 'seen')}) AS regressed, {', '.join(f'bool_or({c} > 0) AS any_{c}' for c in _OPEN)},
  max(CASE WHEN place > 1 AND seen_ms = from_ms AND seen_id = from_id AND {' + '.join(_OPEN)} = 0 THEN place END) AS stable_round FROM watched GROUP BY sweep_id),
counted AS (SELECT sweep_id, count(*) AS rounds FROM r GROUP BY sweep_id),
joined AS (SELECT s.*, coalesce(rounds, 0) AS rounds, stable_round, coalesce(regressed, false) AS regressed, {', '.join(f'coalesce({c}, false) AS {c}' for c in _FLAGS)} FROM s LEFT JOIN per USING (sweep_id) LEFT JOIN counted USING (sweep_id)),
caught AS (SELECT *, {R.first_text(CATCH_UP, 'NOT_STABLE')} AS catch_up FROM joined),
aborted AS (SELECT *, {R.reasons_text(SWEEP_REASONS)} AS abort_reasons FROM caught),
generations AS (SELECT sweep_id, catch_up, CASE WHEN abort_reasons = '' AND catch_up = 'NOT_STABLE' THEN 'CATCH_UP_NOT_STABLE' ELSE abort_reasons END AS abort_reasons, {R.first_text(GENERATION_STATES, 'VERIFIED')} AS state FROM aborted)"""


def evaluate_generations(sweeps: DataFrame, rounds: DataFrame) -> DataFrame:
    """(sweep_id, catch_up, abort_reasons, state): a sweep is verified if its account is sound and its journal stood still.

    Rounds count in their order up to the budget; a round that repeats the
    high water of the one before, with nothing open, is stable.
    """
    order = ["round", "order_by", "seen_id", *_OPEN]
    by_round = Window.partitionBy("sweep_id").orderBy(*order)
    ranked = rounds.select("*", F.row_number().over(by_round).alias("place"), F.lag("seen_ms").over(by_round).alias("last_ms"), F.lag("seen_id").over(by_round).alias("last_id"))
    watched = ranked.join(sweeps.select("sweep_id", "budget", "before_ms", "before_id"), "sweep_id").where("place <= greatest(budget, 2)")
    watched = watched.withColumns({"from_ms": F.coalesce("last_ms", "before_ms"), "from_id": F.coalesce("last_id", "before_id")})
    still = R.expression(f"place > 1 AND seen_ms = from_ms AND seen_id = from_id AND {' + '.join(_OPEN)} = 0")
    per = watched.groupBy("sweep_id").agg(F.bool_or(R.expression(R.later("from", "seen"))).alias("regressed"), *(F.bool_or(F.col(c) > 0).alias(f"any_{c}") for c in _OPEN), F.max(F.when(still, F.col("place"))).alias("stable_round"))
    counted = rounds.groupBy("sweep_id").agg(F.count(F.lit(1)).alias("rounds"))
    joined = sweeps.join(per, "sweep_id", "left").join(counted, "sweep_id", "left")
    joined = joined.withColumns({**{c: F.coalesce(c, F.lit(False)) for c in ("regressed", *_FLAGS)}, "rounds": F.coalesce("rounds", F.lit(0))})
    told = joined.withColumn("catch_up", R.first(CATCH_UP, "NOT_STABLE")).withColumn("abort_reasons", R.reasons(SWEEP_REASONS))
    unstable = (F.col("abort_reasons") == "") & (F.col("catch_up") == "NOT_STABLE")
    return told.select("sweep_id", "catch_up", F.when(unstable, "CATCH_UP_NOT_STABLE").otherwise(F.col("abort_reasons")).alias("abort_reasons"), R.first(GENERATION_STATES, "VERIFIED").alias("state"))


def sweeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.derived(read(spark, sf_dir, "orders"), SWEEP)




@query("manifest_validation", f"WITH s AS ({R.derived_text('orders', {**SWEEP, 'generation': GENERATION})}), told AS (SELECT sweep_id, {R.reasons_text(MANIFEST)} AS reasons FROM s) SELECT *, reasons = '' AS eligible FROM told")
def manifest_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a snapshot is complete, safe, in time order and of known origin."""
    told = R.derived(read(spark, sf_dir, "orders"), {**SWEEP, "generation": GENERATION}).select("sweep_id", R.reasons(MANIFEST).alias("reasons"))
    return told.select("*", (F.col("reasons") == "").alias("eligible"))


@query("transport_accounting", f"WITH s AS ({R.derived_text('orders', SWEEP)}) SELECT sweep_id, {R.reasons_text(TRANSPORT)} AS reasons FROM s")
def transport_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a sweep's account of pages, requests and listings."""
    return sweeps(spark, sf_dir).select("sweep_id", R.reasons(TRANSPORT).alias("reasons"))


@query("generation_evaluation", GENERATION_SQL + " SELECT * FROM generations")
def generation_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_generations(sweeps(spark, sf_dir), R.derived(read(spark, sf_dir, "lineitem"), ROUND))


#: Candidates of a sweep, the bundles that hold them, and what keeps them from a targeted look.
ADVANCING = {
    "sweep_id": "l_orderkey", "order_hash": "CAST(l_partkey % 3 AS STRING)", "class": "CASE WHEN l_partkey % 41 = 7 THEN 'MISSING' WHEN l_suppkey % 3 = 0 THEN 'PRESENT' WHEN l_suppkey % 3 = 1 THEN 'ABSENT_CANDIDATE' ELSE 'BLOCKED' END", "identity_ok": "l_suppkey % 29 <> 1",
    "row_authority": "l_partkey % 43 = 8",
}
BUNDLE = {"sweep_id": "o_orderkey", "model_ok": "o_custkey % 31 <> 2", "manifest_ok": "o_orderkey % 41 <> 5", "bundle_authority": "o_custkey % 37 = 3", "own_sweep": "o_orderkey % 89 <> 4"}
_KNOWN_CLASS = "class IN ('PRESENT', 'ABSENT_CANDIDATE', 'BLOCKED')"
ADVANCE_REASONS: R.Rules = (
    # of the bundle: each of its candidates bears them
    ("INVALID_CANDIDATE_BUNDLE", "NOT coalesce(model_ok AND manifest_ok, false)"), ("CANDIDATE_SWEEP_MISMATCH", "NOT own_sweep"), ("FENCE_BLOCKED", "state IS NULL OR state <> 'VERIFIED'"),
    # of the candidate, or the bundle
    ("INVALID_CANDIDATE_AUTHORITY", "bundle_authority OR row_authority"),
    # of the candidate
    ("INVALID_CANDIDATE_IDENTITY", "NOT all_ok"), ("DUPLICATE_CANDIDATE_IDENTITY", "copies > 1"), ("UNKNOWN_CANDIDATE_CLASSIFICATION", f"NOT coalesce({_KNOWN_CLASS}, false)"),
)


@query("candidate_advancement", GENERATION_SQL + f""", c AS ({R.derived_text('lineitem', ADVANCING)}), b AS ({R.derived_text('orders', BUNDLE)}),
keyed AS (SELECT c.*, count(*) OVER (PARTITION BY sweep_id, order_hash) AS copies, bool_and(identity_ok) OVER (PARTITION BY sweep_id, order_hash) AS all_ok FROM c),
told AS (SELECT k.sweep_id, order_hash, CASE WHEN {_KNOWN_CLASS} THEN class ELSE 'BLOCKED' END AS class, {R.reasons_text(ADVANCE_REASONS)} AS reasons FROM keyed k LEFT JOIN generations g USING (sweep_id) LEFT JOIN b USING (sweep_id))
SELECT *, reasons = '' AND class = 'ABSENT_CANDIDATE' AS eligible FROM told""")
def candidate_advancement(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = R.derived(read(spark, sf_dir, "orders"), BUNDLE)
    return advance_candidates(R.derived(read(spark, sf_dir, "lineitem"), ADVANCING), bundles, generation_evaluation(spark, sf_dir))


def advance_candidates(candidates: DataFrame, bundles: DataFrame, generations: DataFrame) -> DataFrame:
    """(sweep_id, order_hash, class, reasons, eligible): absent candidates of a sound bundle and a verified generation, each alone of its identity.

    What is wrong with a bundle keeps all of its candidates back, sound ones too; a class that is unknown counts as blocked.
    """
    per_key = candidates.groupBy("sweep_id", "order_hash").agg(F.count(F.lit(1)).alias("copies"), F.bool_and("identity_ok").alias("all_ok"))
    whole = candidates.join(per_key, ["sweep_id", "order_hash"]).join(bundles, "sweep_id", "left").join(generations.select("sweep_id", "state"), "sweep_id", "left")
    told = whole.withColumn("reasons", R.reasons(ADVANCE_REASONS)).withColumn("class", F.when(R.expression(_KNOWN_CLASS), F.col("class")).otherwise("BLOCKED"))
    return told.select("sweep_id", "order_hash", "class", "reasons", ((F.col("reasons") == "") & (F.col("class") == "ABSENT_CANDIDATE")).alias("eligible"))


#: What is wrong with a stored generation: it must follow from its evidence.
RESULT_PROBLEMS: R.Rules = (
    ("EVIDENCE_MISSING", "own_state IS NULL"), ("STATE_MISMATCH", "state <> own_state"), ("CATCH_UP_MISMATCH", "catch_up <> own_catch_up"), ("REASONS_MISMATCH", "abort_reasons <> own_reasons"), ("FENCE_MISMATCH", "fence <> CASE WHEN own_state = 'VERIFIED' THEN 'FENCE_ELIGIBLE' ELSE 'FENCE_BLOCKED' END"),
)


@query("generation_result_check", GENERATION_SQL + f""", stored AS (SELECT sweep_id + CASE WHEN sweep_id % 997 = 3 THEN 100000000 ELSE 0 END AS sweep_id, CASE WHEN sweep_id % 101 = 1 THEN 'VERIFIED' ELSE state END AS state, CASE WHEN sweep_id % 103 = 1 THEN 'STABLE' ELSE catch_up END AS catch_up,
  CASE WHEN sweep_id % 107 = 1 THEN '' ELSE abort_reasons END AS abort_reasons, CASE WHEN state = 'VERIFIED' OR sweep_id % 109 = 1 THEN 'FENCE_ELIGIBLE' ELSE 'FENCE_BLOCKED' END AS fence FROM generations),
told AS (SELECT stored.*, g.state AS own_state, g.catch_up AS own_catch_up, g.abort_reasons AS own_reasons FROM stored LEFT JOIN generations g USING (sweep_id)), checked AS (SELECT sweep_id, {R.reasons_text(RESULT_PROBLEMS)} AS problems FROM told)
SELECT * FROM checked WHERE problems <> ''""")
def generation_result_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored generations (some altered, by the rule of the SQL) against what their evidence gives."""
    own = generation_evaluation(spark, sf_dir)
    altered = {
        "sweep_id": "sweep_id + CASE WHEN sweep_id % 997 = 3 THEN 100000000 ELSE 0 END", "state": "CASE WHEN sweep_id % 101 = 1 THEN 'VERIFIED' ELSE state END", "catch_up": "CASE WHEN sweep_id % 103 = 1 THEN 'STABLE' ELSE catch_up END",
        "abort_reasons": "CASE WHEN sweep_id % 107 = 1 THEN '' ELSE abort_reasons END", "fence": "CASE WHEN state = 'VERIFIED' OR sweep_id % 109 = 1 THEN 'FENCE_ELIGIBLE' ELSE 'FENCE_BLOCKED' END",
    }
    return check_generations(R.derived(own, altered), own)


def check_generations(stored: DataFrame, own: DataFrame) -> DataFrame:
    """(sweep_id, problems) of stored generations that don't follow from their evidence."""
    beside = own.select("sweep_id", F.col("state").alias("own_state"), F.col("catch_up").alias("own_catch_up"), F.col("abort_reasons").alias("own_reasons"))
    return stored.join(beside, "sweep_id", "left").select("sweep_id", R.reasons(RESULT_PROBLEMS).alias("problems")).where("problems <> ''")


#: Listings of first snapshots, one snapshot for each country.
LISTING = {
    "snapshot": "c_nationkey", "order_hash": "CAST(CASE WHEN c_nationkey % 5 = 1 THEN c_custkey % 40 ELSE c_custkey END AS STRING)", "protocol": "CASE WHEN c_nationkey % 5 = 2 THEN CASE WHEN c_custkey % 3 = 0 THEN 'p1' ELSE 'p2' END WHEN c_nationkey % 5 = 3 THEN NULL ELSE 'p1' END", "in_scope": "c_nationkey % 7 <> 4 OR c_acctbal > 0",
}
BASELINE_PROBLEMS: R.Rules = (("INITIAL_GENERATION_DUPLICATE_ORDER", "listings > orders"), ("INITIAL_GENERATION_PROTOCOL_UNPROVEN", "protocols = 0 OR unproven > 0"), ("INITIAL_GENERATION_PROTOCOL_AMBIGUOUS", "protocols > 1"), ("INITIAL_GENERATION_IDENTITY_MISMATCH", "outside > 0"))


@query("baseline_projection", f"""WITH l AS ({R.derived_text('customer', LISTING)}),
told AS (SELECT snapshot, count(*) AS listings, count(DISTINCT order_hash) AS orders, count(DISTINCT protocol) AS protocols, count(*) FILTER (WHERE protocol IS NULL) AS unproven, count(*) FILTER (WHERE NOT in_scope) AS outside, min(protocol) AS protocol,
  md5(string_agg(order_hash || '|' || coalesce(protocol, ''), ',' ORDER BY order_hash, protocol)) AS scope_fingerprint FROM l GROUP BY snapshot), judged AS (SELECT *, {R.first_text(BASELINE_PROBLEMS, None)} AS problem FROM told)
SELECT snapshot, problem, listings, CASE WHEN problem IS NULL THEN protocol END AS protocol, CASE WHEN problem IS NULL THEN scope_fingerprint END AS scope_fingerprint FROM judged""")
def baseline_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_baseline(R.derived(read(spark, sf_dir, "customer"), LISTING))


def project_baseline(listings: DataFrame) -> DataFrame:
    """(snapshot, problem, listings, protocol, scope_fingerprint): unique orders in scope under one protocol, or what forbids it.

    The fingerprint hashes the sorted identities of a snapshot, which is
    bounded by the provider's limit on its rows.
    """
    line = F.concat("order_hash", F.lit("|"), F.coalesce("protocol", F.lit("")))
    told = listings.groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("listings"), F.count_distinct("order_hash").alias("orders"), F.count_distinct("protocol").alias("protocols"), F.count_if(F.col("protocol").isNull()).alias("unproven"), F.count_if(~F.col("in_scope")).alias("outside"),
        F.min("protocol").alias("protocol"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order_hash", "protocol", line.alias("line")))), lambda x: x["line"]), ",")).alias("scope_fingerprint"),
    )
    judged = told.withColumn("problem", R.first(BASELINE_PROBLEMS, None))
    good = F.col("problem").isNull()
    return judged.select("snapshot", "problem", "listings", F.when(good, F.col("protocol")).alias("protocol"), F.when(good, F.col("scope_fingerprint")).alias("scope_fingerprint"))


#: Counts that must be zero before a recovery may start, in the order in which they are told.
ANCHOR: R.Rules = (
    ("ACTIVE_LISTINGS_PRESENT", "active_listings <> 0"), ("ALREADY_ADOPTED", "adoptions <> 0"), ("GENERIC_PENDING", "pending <> 0"), ("PROCESSING", "processing <> 0"), ("FAILED", "failed <> 0"), ("STALE_PROCESSING", "stale <> 0"), ("INGESTION_ALREADY_RUNNING", "leases <> 0"),
)


#: A journal at rest but for a few rows: what is open, how long, and what an earlier adoption wrote.
_ANCHOR_STATUS = "CASE WHEN processing_status IN ('pending', 'processing', 'failed') AND event_id % 61 <> 3 THEN 'applied' ELSE processing_status END"
#: How long a row may be processed before it counts as stale.
STALE_MS = 15 * 60_000


@query("recovery_anchor", LATEST_SQL + f""", w AS (SELECT *, {_ANCHOR_STATUS} AS status FROM j),
c AS (SELECT token_id, count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'processing') AS processing, count(*) FILTER (WHERE status = 'failed') AS failed,
  count(*) FILTER (WHERE status = 'processing' AND started_ms < {NOW} - {STALE_MS}) AS stale, count(*) FILTER (WHERE event_id % 577 = 5) AS leases, count(*) FILTER (WHERE event_id % 587 = 7) AS adoptions, max(event_id) AS high_id FROM w GROUP BY token_id),
whole AS (SELECT c.*, coalesce(n, 0) AS active_listings FROM c LEFT JOIN (SELECT token_id, count(*) AS n FROM latest WHERE last_type = 'item_listed' GROUP BY token_id) USING (token_id))
SELECT token_id, high_id, {R.first_text(ANCHOR, 'READY')} AS anchor, pending, processing, failed, stale FROM whole""")
def recovery_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each asset's journal and state are at rest, so that a recovery may start from its high water; every open row counts."""
    rows = journal(spark, sf_dir)
    status = R.expression(_ANCHOR_STATUS)
    counts = rows.withColumn("status", status).groupBy("token_id").agg(
        *(F.count_if(F.col("status") == s).alias(s) for s in ("pending", "processing", "failed")), F.count_if((F.col("status") == "processing") & (F.col("started_ms") < NOW - STALE_MS)).alias("stale"),
        F.count_if(F.col("event_id") % 577 == 5).alias("leases"), F.count_if(F.col("event_id") % 587 == 7).alias("adoptions"), F.max("event_id").alias("high_id"),
    )
    active = latest_orders(rows).where("last_type = 'item_listed'").groupBy("token_id").agg(F.count(F.lit(1)).alias("active_listings"))
    whole = counts.join(active, "token_id", "left").withColumn("active_listings", F.coalesce("active_listings", F.lit(0)))
    return whole.select("token_id", "high_id", R.first(ANCHOR, "READY").alias("anchor"), "pending", "processing", "failed", "stale")
