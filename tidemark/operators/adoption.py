"""Adopting a snapshot as the baseline of order state: a job of steps, each written once, that may stop and run again anywhere.

Steps are folders below the job's own. One is done when its table is written
whole (its ``_SUCCESS`` is there); a run reads what is done and writes anew
what is not. The receipt is last: states count as adopted only beside it, and
a run that finds one compares it with its plan and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.operators.folds import FENCE, ORDER_ACTION, ORDER_EVENT, ORDER_MACHINE, SNAPSHOT_END, STATE_COLUMNS, duck_fold, order_states, ordered_events, spark_fold
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, NOW, journal
from tidemark.sources.staging import shared_folder

STATE = list(ORDER_MACHINE)
#: Statuses of events that may lie behind the fence, and those among them that are passed over.
SAFE = "('applied', 'reconciliation_required', 'ignored_duplicate', 'ignored_older')"
PASSED_OVER = "('ignored_duplicate', 'ignored_older')"
#: What forbids adoption, tried from the top, over counts of the plan, of existing orders and of events behind the fence.
REFUSALS: R.Rules = (
    ("INITIAL_BASELINE_DUPLICATE_ORDER", "duplicates > 0"), ("INITIAL_BASELINE_IDENTITY_MISMATCH", "incomplete > 0"), ("INITIAL_BASELINE_SNAPSHOT_EXPIRED", "expired > 0"),
    ("INITIAL_BASELINE_EXISTING_IDENTITY_CONFLICT", "other_identity > 0"), ("INITIAL_BASELINE_EXISTING_ADOPTION_CONFLICT", "other_adoption > 0"),
    ("INITIAL_BASELINE_POST_STABLE_EVENT_MALFORMED", "malformed > 0"), ("INITIAL_BASELINE_POST_STABLE_EVENT_UNSAFE_STATUS", "unsafe > 0"),
)
#: Counts of a durable adoption that must all be zero.
ZERO = ("receipts_missing", "receipts_differing", "linked_missing", "linked_surplus", "linked_twice", "identities_differing", "states_differing", "events_unsafe", "events_malformed")


class AdoptionRefused(ValueError):
    """The plan, the existing orders or the journal forbid adoption; nothing was adopted."""


def commitment(rows: DataFrame, key: str) -> str:
    """One hash over all rows in the order of their keys, by buckets of hashed keys; 4,096 bucket hashes meet in one task."""
    line = F.struct(key, F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256).alias("hash"))
    buckets = rows.groupBy(F.substring(F.sha2(F.col(key), 256), 1, 3).alias("bucket")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["hash"]), "\n"), 256).alias("hash"))
    return buckets.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "hash"))), lambda x: x["hash"]), "\n"), 256)).first()[0]


def touching(events: DataFrame, orders: DataFrame, snapshot_end: int) -> DataFrame:
    """Events that are replayed on ``orders`` (order_hash, nft): their own, and transfers of their assets, after the snapshot or without a time."""
    later = events.where(f"processing_status NOT IN {PASSED_OVER} AND (event_ms IS NULL OR event_ms > {snapshot_end})")
    own = later.where("event_type <> 'item_transferred'").join(orders.select("order_hash"), "order_hash", "left_semi")
    moves = later.where("event_type = 'item_transferred'").drop("order_hash").join(orders.select("order_hash", F.col("nft").alias("nft_id")), "nft_id")
    return own.unionByName(moves.select(own.columns))


def folded_from(states: DataFrame, events: DataFrame) -> DataFrame:
    """(order_hash, state fields): ``states`` after ``events``; states without events stay as they are."""
    grouped = ordered_events(events, "order_hash", ORDER_EVENT)
    both = states.select("order_hash", F.struct(*STATE).alias("held")).join(grouped, "order_hash", "left")
    stepped = F.expr(spark_fold(ORDER_MACHINE, ORDER_ACTION, "events", first="held"))
    return both.select("order_hash", F.when(F.col("events").isNull(), F.col("held")).otherwise(stepped).alias("s")).select("order_hash", "s.*")


class Adoption:
    """One job: ``folder`` is its own; ``snapshot`` (order_hash, nft, seller, price, exp, ms), ``states`` (order_hash, state fields,
    adoption_id) before it, and ``events`` of the journal behind the fence.

    With ``reset``, orders that exist begin anew from the snapshot, as after a loss of continuity; else they go on from
    their state. ``told`` is called with the name of each step that was written.
    """

    def __init__(self, spark: SparkSession, folder: str, snapshot: DataFrame, states: DataFrame, events: DataFrame, snapshot_end: int, now: int, reset: bool = False, told: Callable[[str], None] = lambda step: None) -> None:
        self.spark, self.folder, self.snapshot, self.states, self.events = spark, folder, snapshot, states, events
        self.snapshot_end, self.now, self.reset, self.told = snapshot_end, now, reset, told

    def done(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.done(name):
            make().write.mode("overwrite").parquet(f"{self.folder}/{name}")
            self.told(name)
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def refusal(self, plan: DataFrame, adoption_id: str) -> str | None:
        per_order = plan.groupBy("order_hash").agg(F.count(F.lit(1)).alias("n"), F.first("nft").alias("nft"))
        complete = F.expr("order_hash IS NOT NULL AND nft IS NOT NULL AND seller IS NOT NULL AND price IS NOT NULL AND exp IS NOT NULL")
        rows = plan.agg(F.count_if(~complete).alias("incomplete"), F.count_if(F.col("exp") <= self.now).alias("expired"))
        met = per_order.join(self.states.select("order_hash", F.col("nft").alias("own_nft"), "adoption_id"), "order_hash", "left").agg(
            F.count_if(F.col("n") > 1).alias("duplicates"), F.count_if(F.col("own_nft") != F.col("nft")).alias("other_identity"), F.count_if(F.col("adoption_id") != adoption_id).alias("other_adoption")
        )
        seen = self.events.agg(F.count_if(F.expr(MALFORMED)).alias("malformed"), F.count_if(F.expr(UNSAFE)).alias("unsafe"))
        counts = {k: v for part in (rows, met, seen) for k, v in part.first().asDict().items()}
        return self.spark.createDataFrame([counts]).select(R.first(REFUSALS, None).alias("refusal")).first()["refusal"]

    def seeded(self, plan: DataFrame, adoption_id: str) -> DataFrame:
        """All states, those of the plan bearing its id: new ones active as the snapshot lists them, existing ones as they were or anew."""
        values = {**{n: F.lit(None) if v == "NULL" else F.expr(v) for n, (_, v, _) in ORDER_MACHINE.items()}, "here": F.lit(True), "status": F.lit("active"), "is_active": F.lit(True), "last_type": F.lit("item_listed"), "last_ms": F.col("ms"), "outcome": F.lit("inserted_active")}
        values |= {n: F.col(n) for n in ("seller", "price", "exp", "nft")}
        new = plan.select("order_hash", F.struct(*(values[n].cast(t).alias(n) for n, (t, _, _) in ORDER_MACHINE.items())).alias("new"))
        both = self.states.select("order_hash", F.struct(*(F.col(n).cast(t).alias(n) for n, (t, _, _) in ORDER_MACHINE.items())).alias("old"), "adoption_id").join(new, "order_hash", "full")
        chosen = F.coalesce("new", "old") if self.reset else F.coalesce("old", "new")
        step = F.when(F.col("new").isNull(), "leave").when(F.col("old").isNull(), "seed").otherwise("reset" if self.reset else "attach")
        return both.select("order_hash", chosen.alias("s"), F.when(F.col("new").isNotNull(), adoption_id).otherwise(F.col("adoption_id")).alias("adoption_id"), step.alias("step")).select("order_hash", "s.*", "adoption_id", "step")

    def replayed(self, seeded: DataFrame) -> DataFrame:
        events = touching(self.events, seeded.select("order_hash", "nft"), self.snapshot_end)
        return folded_from(seeded, events).join(seeded.select("order_hash", "adoption_id", "step"), "order_hash")

    def run(self) -> str:
        """ADOPTED or ALREADY_ADOPTED; an ``AdoptionRefused`` leaves no receipt."""
        plan = self.step("plan", lambda: self.snapshot.select("order_hash", "nft", "seller", "price", "exp", "ms"))
        adoption_id = commitment(plan, "order_hash")
        if self.done("receipt"):
            if self.spark.read.parquet(f"{self.folder}/receipt").where(F.col("adoption_id") == adoption_id).count() != 1:
                raise AdoptionRefused("INITIAL_BASELINE_DURABLE_CORRUPTION")
            return "ALREADY_ADOPTED"
        if refusal := self.refusal(plan, adoption_id):
            raise AdoptionRefused(refusal)
        seeded = self.step("seeded", lambda: self.seeded(plan, adoption_id))
        replayed = self.step("replayed", lambda: self.replayed(seeded))
        expected, linked = plan.count(), replayed.where(F.col("adoption_id") == adoption_id).count()
        if expected != linked:
            raise AdoptionRefused("INITIAL_BASELINE_DURABLE_CORRUPTION")
        states = commitment(replayed, "order_hash")
        self.step("receipt", lambda: self.spark.createDataFrame([(adoption_id, expected, linked, states)], "adoption_id string, expected_order_count bigint, adopted_order_count bigint, rows_commitment string"))
        return "ADOPTED"

    def adopted(self) -> DataFrame:
        """States after adoption; without a receipt, those before it."""
        return self.spark.read.parquet(f"{self.folder}/replayed") if self.done("receipt") else self.states.withColumn("step", F.lit("leave"))

    def verified(self) -> dict[str, int]:
        """``ZERO`` counts of what is stored against the snapshot, the states before and the journal, all read again; adoption is durable if all are zero."""
        adoption_id = commitment(self.snapshot.select("order_hash", "nft", "seller", "price", "exp", "ms"), "order_hash")
        receipts = self.spark.read.parquet(f"{self.folder}/receipt") if self.done("receipt") else self.spark.createDataFrame([], "adoption_id string, expected_order_count bigint, adopted_order_count bigint, rows_commitment string")
        durable = self.adopted()
        own = receipts.where(F.col("adoption_id") == adoption_id)
        linked = durable.where(F.col("adoption_id") == adoption_id).select("order_hash", F.col("nft").alias("linked_nft"))
        met = self.snapshot.select("order_hash", "nft").join(linked, "order_hash", "full")
        again = self.replayed(self.seeded(self.snapshot, adoption_id)).select(durable.columns)
        events = self.events.agg(F.count_if(F.expr(UNSAFE)).alias("events_unsafe"), F.count_if(F.expr(MALFORMED)).alias("events_malformed")).first()
        counted = met.agg(F.count_if(F.col("linked_nft").isNull()).alias("linked_missing"), F.count_if(F.col("nft").isNull()).alias("linked_surplus"), F.count_if(F.col("nft") != F.col("linked_nft")).alias("identities_differing")).first()
        return {
            "receipts_missing": int(own.isEmpty()), "receipts_differing": receipts.count() - own.where((F.col("rows_commitment") == commitment(durable, "order_hash")) & (F.col("expected_order_count") == self.snapshot.count())).count(),
            "linked_twice": linked.count() - linked.select("order_hash").distinct().count(), "states_differing": again.exceptAll(durable).count() + durable.exceptAll(again).count(), **counted.asDict(), **events.asDict(),
        }


MALFORMED = "chain IS NULL OR contract_address IS NULL OR (event_type = 'item_transferred' AND token_id IS NULL) OR (event_type <> 'item_transferred' AND order_hash IS NULL)"
UNSAFE = f"processing_status NOT IN {SAFE}"

#: Events behind the fence, all settled; the snapshot's orders are those whose last complete listing lies before it.
_SETTLED = f"CASE WHEN processing_status IN {SAFE} THEN processing_status ELSE 'applied' END"
_LISTED = f"event_type = 'item_listed' AND received_ms <= {FENCE} AND seller IS NOT NULL AND price_raw IS NOT NULL AND expiration_ms > {NOW}"
#: Assets whose orders the store knows already.
_KNOWN = "CAST(token_id AS BIGINT) % 2 = 0"


@query("adoption_job", JOURNAL_SQL + f""", snap AS (SELECT order_hash, arg_max(nft_id, (received_ms, event_id)) AS nft_id, arg_max(seller, (received_ms, event_id)) AS seller, arg_max(price_raw, (received_ms, event_id)) AS price_raw, arg_max(expiration_ms, (received_ms, event_id)) AS expiration_ms FROM j WHERE {_LISTED} GROUP BY order_hash),
later AS (SELECT * REPLACE ({_SETTLED} AS processing_status) FROM j WHERE received_ms > {FENCE}),
kept AS (SELECT * FROM later WHERE processing_status NOT IN {PASSED_OVER} AND (event_ms IS NULL OR event_ms > {SNAPSHOT_END})),
old AS (SELECT * FROM j WHERE order_hash IS NOT NULL AND received_ms <= {FENCE} AND {_KNOWN}),
old_state AS (SELECT order_hash, """ + duck_fold(ORDER_MACHINE, ORDER_ACTION, "", ORDER_EVENT) + f""".s AS s FROM old GROUP BY order_hash),
known AS (SELECT order_hash, s.nft AS nft FROM old_state WHERE s.here),
orders_ AS (SELECT order_hash, nft FROM known UNION SELECT order_hash, nft_id FROM snap WHERE order_hash NOT IN (SELECT order_hash FROM known)),
seeds AS (SELECT -1 AS event_id, 'item_listed' AS event_type, 0 AS received_ms, CAST({SNAPSHOT_END} AS BIGINT) AS event_ms, CAST(NULL AS BIGINT) AS event_version, order_hash, nft_id, seller, price_raw, expiration_ms, 0 AS k FROM snap WHERE order_hash NOT IN (SELECT order_hash FROM known)),
every AS (SELECT * FROM seeds UNION ALL SELECT event_id, event_type, received_ms, event_ms, event_version, order_hash, nft_id, seller, price_raw, expiration_ms, k FROM old WHERE order_hash IN (SELECT order_hash FROM known)
  UNION ALL SELECT event_id, event_type, received_ms, event_ms, event_version, order_hash, nft_id, seller, price_raw, expiration_ms, k FROM kept WHERE event_type <> 'item_transferred' AND order_hash IN (SELECT order_hash FROM orders_)
  UNION ALL SELECT event_id, event_type, received_ms, event_ms, event_version, o.order_hash, nft_id, seller, price_raw, expiration_ms, k FROM kept JOIN orders_ o ON o.nft = kept.nft_id WHERE event_type = 'item_transferred'),
folded AS (SELECT order_hash, """ + duck_fold(ORDER_MACHINE, ORDER_ACTION, "", ORDER_EVENT) + f""".s AS s FROM every GROUP BY order_hash)
SELECT order_hash, CASE WHEN order_hash NOT IN (SELECT order_hash FROM snap) THEN 'leave' WHEN order_hash IN (SELECT order_hash FROM known) THEN 'attach' ELSE 'seed' END AS step, {', '.join(f's.{c} AS {c}' for c in STATE_COLUMNS)} FROM folded""")
def adoption_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States after a snapshot was adopted and the journal behind it replayed; the job runs twice, and the second changes nothing."""
    job = journal_adoption(spark, journal(spark, sf_dir), shared_folder(spark))
    if job.run() != "ADOPTED" or job.run() != "ALREADY_ADOPTED":
        raise AdoptionRefused("INITIAL_BASELINE_DURABLE_CORRUPTION")
    return job.adopted().select("order_hash", "step", *STATE_COLUMNS)


def journal_adoption(spark: SparkSession, rows: DataFrame, folder: str, **settings: object) -> Adoption:
    """The job for the journal's fence: its snapshot, the states of the assets that the store knows, and the events behind it."""
    last = F.max_by(F.struct(F.col("nft_id").alias("nft"), "seller", F.col("price_raw").alias("price"), F.col("expiration_ms").alias("exp")), F.struct("received_ms", "event_id"))
    snapshot = rows.where(_LISTED).groupBy("order_hash").agg(last.alias("x")).select("order_hash", "x.*", F.lit(SNAPSHOT_END).cast("bigint").alias("ms"))
    states = order_states(rows.where(f"order_hash IS NOT NULL AND received_ms <= {FENCE} AND {_KNOWN}")).withColumn("adoption_id", F.lit(None).cast("string"))
    return Adoption(spark, folder, snapshot, states, rows.where(f"received_ms > {FENCE}").withColumn("processing_status", F.expr(_SETTLED)), SNAPSHOT_END, NOW, **settings)
