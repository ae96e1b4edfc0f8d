"""Looks at the journal from outside: chronology of transfers, candidates of a look, invariants, probes and log lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType

from tidemark.functions import json_text
from tidemark.functions import rules as R
from tidemark.operators.joins import LATEST_SQL, NFT, active_orders
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, NOW, STATUSES, journal, read

#: How a pending transfer stands to the last one that its asset has seen.
CHRONOLOGY: R.Rules = (
    ("UNSAFE_TO_DETERMINE", "token_id IS NULL OR event_ms IS NULL OR transaction_hash IS NULL"), ("AMBIGUOUS", "last_ms IS NOT NULL AND last_version IS NOT NULL AND event_ms = last_ms AND event_version IS NULL"),
    ("IGNORED_OLDER", "last_ms IS NOT NULL AND (event_ms < last_ms OR (event_ms = last_ms AND event_version < last_version))"),
)
#: What speaks against a row; the normal reasons make it no candidate, any other makes the look unsafe.
ROW_REASONS: R.Rules = (
    ("event_type_mismatch", "event_type <> 'item_transferred'"), ("event_not_pending", "processing_status <> 'pending'"), ("attempt_count_not_zero", "attempt_count <> 0"), ("malformed_transfer_payload", "event_ms IS NULL OR transaction_hash IS NULL"),
    ("active_order_count_not_one", "active = 0"), ("multiple_matching_active_orders", "active > 1"), ("chronology_ambiguous", "chronology = 'AMBIGUOUS'"), ("chronology_ignored_older", "chronology = 'IGNORED_OLDER'"), ("chronology_unsafe_to_determine", "chronology = 'UNSAFE_TO_DETERMINE'"),
)
NORMAL = ("event_type_mismatch", "event_not_pending", "attempt_count_not_zero", "active_order_count_not_one", "multiple_matching_active_orders", "chronology_ignored_older")
VERDICTS: R.Rules = (("UNSAFE", "unsafe > 0"), ("NO_CANDIDATE", "safe = 0"), ("CANDIDATE_FOUND", "safe = 1"))

OBSERVED_SQL = LATEST_SQL + f""", seen AS (SELECT chain, contract_address, token_id, max(event_ms) AS last_ms FROM j WHERE event_type = 'item_transferred' AND processing_status = 'applied' AND transaction_hash IS NOT NULL GROUP BY ALL),
versions AS (SELECT chain, contract_address, token_id, last_ms, max(event_version) AS last_version FROM j JOIN seen USING (chain, contract_address, token_id) WHERE event_type = 'item_transferred' AND processing_status = 'applied' AND transaction_hash IS NOT NULL AND event_ms = last_ms GROUP BY ALL),
orders_of AS (SELECT chain, contract_address, token_id, count(*) AS active FROM active GROUP BY ALL),
rows AS (SELECT j.*, last_ms, last_version, coalesce(active, 0) AS active FROM j LEFT JOIN versions USING (chain, contract_address, token_id) LEFT JOIN orders_of USING (chain, contract_address, token_id)),
timed AS (SELECT *, {R.first_text(CHRONOLOGY, 'APPLY')} AS chronology FROM rows), told AS (SELECT *, {R.reasons_text(ROW_REASONS)} AS reasons FROM timed)"""


def observe(rows: DataFrame) -> DataFrame:
    """The journal's rows with chronology and reasons."""
    moved = rows.where("event_type = 'item_transferred' AND processing_status = 'applied' AND transaction_hash IS NOT NULL")
    versioned = F.when(F.col("event_version").isNotNull(), F.col("event_version")).otherwise(F.lit(-1))
    last = moved.groupBy(*NFT).agg(F.max(F.struct("event_ms", versioned.alias("v"))).alias("m")).select(*NFT, F.col("m.event_ms").alias("last_ms"), F.when(F.col("m.v") >= 0, F.col("m.v")).alias("last_version"))
    counted = active_orders(rows).groupBy(*NFT).agg(F.count(F.lit(1)).alias("active"))
    both = rows.join(last, NFT, "left").join(counted, NFT, "left").withColumn("active", F.coalesce("active", F.lit(0)))
    return both.withColumn("chronology", R.first(CHRONOLOGY, "APPLY")).withColumn("reasons", R.reasons(ROW_REASONS))


@query("transfer_chronology", OBSERVED_SQL + " SELECT event_id, chronology, reasons FROM told WHERE event_type = 'item_transferred'")
def transfer_chronology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe(journal(spark, sf_dir)).where("event_type = 'item_transferred'").select("event_id", "chronology", "reasons")


_UNSAFE = "len(list_filter(str_split(reasons, ','), lambda x: x NOT IN (" + ", ".join(f"'{n}'" for n in ("", *NORMAL)) + "))) > 0"


@query("observer_verdict", OBSERVED_SQL + f""", counted AS (SELECT token_id, count(*) FILTER (WHERE reasons = '') AS safe, count(*) FILTER (WHERE {_UNSAFE}) AS unsafe FROM told WHERE event_type = 'item_transferred' AND processing_status = 'pending' GROUP BY token_id)
SELECT token_id, {R.first_text(VERDICTS, 'MULTIPLE_CANDIDATES')} AS result, CASE WHEN unsafe > 0 THEN 0 ELSE safe END AS candidates FROM counted""")
def observer_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each asset has exactly one transfer that could be applied now."""
    pending = observe(journal(spark, sf_dir)).where("event_type = 'item_transferred' AND processing_status = 'pending'")
    odd = F.size(F.array_except(F.split("reasons", ","), F.array(F.lit(""), *map(F.lit, NORMAL)))) > 0
    counted = pending.groupBy("token_id").agg(F.count_if(F.col("reasons") == "").alias("safe"), F.count_if(odd).alias("unsafe"))
    return counted.select("token_id", R.first(VERDICTS, "MULTIPLE_CANDIDATES").alias("result"), F.when(F.col("unsafe") > 0, 0).otherwise(F.col("safe")).alias("candidates"))


#: What no row may be after its processing columns were filled in.
INVARIANTS: R.Rules = (("STATUS_MISSING", "processing_status IS NULL"), ("STATUS_UNKNOWN", f"processing_status NOT IN ({', '.join(repr(s) for s in STATUSES)})"), ("ATTEMPTS_MISSING", "attempt_count IS NULL"), ("ATTEMPTS_NEGATIVE", "attempt_count < 0"))
DAMAGED = {"event_id": "event_id", "processing_status": "CASE event_id % 997 WHEN 1 THEN NULL WHEN 2 THEN 'paused' ELSE processing_status END", "attempt_count": "CASE event_id % 991 WHEN 3 THEN NULL WHEN 4 THEN -1 ELSE attempt_count END"}


def violations(rows: DataFrame) -> DataFrame:
    """(event_id, broken) of the rows that break an invariant; there must be none."""
    return rows.select("event_id", R.reasons(INVARIANTS).alias("broken")).where("broken <> ''")


@query("lifecycle_invariants", JOURNAL_SQL + f", damaged AS ({R.derived_text('j', DAMAGED)}), told AS (SELECT event_id, {R.reasons_text(INVARIANTS)} AS broken FROM damaged) SELECT * FROM told WHERE broken <> ''")
def lifecycle_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations(R.derived(journal(spark, sf_dir), DAMAGED))


#: What a probe asks for, one after the other; none: everything (fixed values of the plan).
PROFILES = {"unfiltered": (), "listing": ("item_listed",), "sale": ("item_sold",), "transfer": ("item_transferred",), "mint": ("item_minted",)}


@query("probe_profiles", JOURNAL_SQL + ", profiles AS (" + " UNION ALL ".join(f"SELECT '{n}' AS profile, count(*) AS events, count(DISTINCT token_id) AS assets, count(transaction_hash) AS transactions FROM j" + f" WHERE event_type IN {t!r}".replace(",)", ")") * bool(t) for n, t in PROFILES.items()) + ") SELECT * FROM profiles")
def probe_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of what each profile of the probe would see, from one scan."""
    wanted = F.array(*(F.when(F.lit(True) if not types else F.col("event_type").isin(*types), F.lit(name)) for name, types in PROFILES.items()))
    seen = journal(spark, sf_dir).select(F.explode(F.array_compact(wanted)).alias("profile"), "token_id", "transaction_hash")
    counted = seen.groupBy("profile").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("token_id").alias("assets"), F.count("transaction_hash").alias("transactions"))
    names = spark.createDataFrame([(n,) for n in PROFILES], "profile string")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("events", "assets", "transactions")]
    return names.join(F.broadcast(counted), "profile", "left").select("profile", *zero)


def line_class(message: Column, collection: str) -> Column:
    """joined, socket_activity, fatal_auth or other, of a line of a stream client's log (patterns are fixed values)."""
    literal = re.escape(collection)
    return (
        F.when(message.rlike(rf"(?i)Successfully joined channel [\"']?collection:{literal}"), "joined").when(message.rlike("(?i)connected to socket|connected to wss?:|Successfully joined channel|re-established"), "socket_activity")
        .when(message.rlike(r"(?i)\b(401|403)\b|unauthori[sz]ed|forbidden|invalid.+(api|token)|authentication.+(failed|rejected)"), "fatal_auth").otherwise("other")
    )


#: A client's log lines from journal columns, so that numbers, names and hosts are the data's.
_LINE = """CASE k % 5 WHEN 0 THEN concat('HTTP ', CAST(390 + CAST(token_id AS INT) % 30 AS STRING), ' for ', token_id) WHEN 1 THEN concat('Successfully joined channel "collection:c', CAST(CAST(token_id AS INT) % 9 AS STRING), '"')
  WHEN 2 THEN concat('connected to ', CASE from_address WHEN '0x1' THEN 'wss:' WHEN '0x2' THEN 'socket ' ELSE 'host ' END, nft_id) WHEN 3 THEN concat('Authentication of ', coalesce(seller, 'nobody'), CASE WHEN price_raw IS NULL THEN ' failed' ELSE ' done' END) ELSE concat('took ', CAST(event_id AS STRING), ' ms') END"""


@query("log_line_classes", JOURNAL_SQL + f""", l AS (SELECT event_id, {_LINE} AS line FROM j)
SELECT event_id, CASE WHEN regexp_matches(line, '(?i)Successfully joined channel ["'']?collection:c4') THEN 'joined' WHEN regexp_matches(line, '(?i)connected to socket|connected to wss?:|Successfully joined channel|re-established') THEN 'socket_activity'
  WHEN regexp_matches(line, '(?i)\\b(401|403)\\b|unauthori[sz]ed|forbidden|invalid.+(api|token)|authentication.+(failed|rejected)') THEN 'fatal_auth' ELSE 'other' END AS class FROM l""")
def log_line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal(spark, sf_dir).select("event_id", line_class(F.expr(_LINE), "c4").alias("class"))


def iso_ms(text: Column) -> Column:
    """Milliseconds since 1970 of a time that is written exactly as ``YYYY-MM-DDTHH:MM:SS.mmmZ`` and exists; else null."""
    moment = F.try_to_timestamp(F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\.[0-9]{3}Z$"), text))
    return F.unix_millis(moment)


#: Times as people write them, from journal columns: days and hours that don't exist, and other forms.
_TIME = """concat('2024-', lpad(CAST(k % 13 AS STRING), 2, '0'), '-', lpad(CAST(event_id % 32 AS STRING), 2, '0'), 'T', lpad(CAST(CAST(token_id AS INT) % 25 AS STRING), 2, '0'), ':', lpad(CAST(event_id % 60 AS STRING), 2, '0'), ':07.', CASE WHEN seller IS NULL THEN '12' ELSE '125' END, CASE WHEN price_raw IS NULL THEN '+00:00' ELSE 'Z' END)"""


@query("strict_times", JOURNAL_SQL + f""", t AS (SELECT event_id, {_TIME} AS text FROM j)
SELECT event_id, CASE WHEN regexp_full_match(text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9][.][0-9]{{3}}Z') THEN epoch_ms(try_strptime(text, '%Y-%m-%dT%H:%M:%S.%gZ')) END AS ms FROM t""")
def strict_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times that are written in the strict form and exist."""
    return journal(spark, sf_dir).select("event_id", iso_ms(F.expr(_TIME)).alias("ms"))


@query("attempt_patch", f"""SELECT o_orderkey AS attempt_id, '{{"attempt":' || o_orderkey || ',"lifecycle":"REQUEST_PENDING","lease":"t' || o_custkey || '","claimed_ms":{NOW}}}' AS payload FROM orders""")
def attempt_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of attempts as a claim rewrites them: some members replaced, the others kept."""
    payload = F.struct(F.col("o_orderkey").alias("attempt"), F.lit("NOT_STARTED").alias("lifecycle"), F.lit(None).cast("string").alias("lease"), F.lit(None).cast("long").alias("claimed_ms"))
    claimed = payload.withField("lifecycle", F.lit("REQUEST_PENDING")).withField("lease", F.concat(F.lit("t"), F.col("o_custkey").cast("string"))).withField("claimed_ms", F.lit(NOW))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("attempt_id"), F.to_json(claimed).alias("payload"))


def sorted_map(entries: Column) -> Column:
    """A map's text with its names in order, so that equal maps have equal texts."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))


@query("provenance_map", """SELECT p_partkey AS artifact_id, '{"brand":"' || p_brand || '","size":"' || p_size || '","type":"' || p_type || '"}' AS provenance FROM part""")
def provenance_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.create_map(F.lit("type"), "p_type", F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), "p_brand")
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("artifact_id"), sorted_map(given).alias("provenance"))


def _admitted(text: str | None) -> bool:
    try:
        return text is not None and json_text.admits_listing(json_text.parse(text))
    except ValueError:
        return False


@pandas_udf(BooleanType())
def admitted(texts: pd.Series) -> pd.Series:
    """Whether a JSON text is a listing with all members that are needed, of their types."""
    return texts.map(_admitted)


@pandas_udf(StringType())
def integer_text(tokens: pd.Series) -> pd.Series:
    """The 64-bit integer that a JSON number stands for, exponents and zero fractions included; null for all else."""
    return tokens.map(lambda t: None if t is None or (v := json_text.bounded_integer(json_text.Token(t), 64)) is None else str(v))


#: A number's token from journal columns: its digits, two of them behind the point, and an exponent from -3 to 20.
_TOKEN = "concat(CASE WHEN k % 2 = 0 THEN '-' ELSE '' END, CAST(event_id AS STRING), CASE WHEN seller IS NULL THEN '' ELSE concat('.', lpad(CAST(k % 100 AS STRING), 2, '0')) END, CASE WHEN price_raw IS NULL THEN '' ELSE concat('e', CAST(CAST(token_id AS INT) % 24 - 3 AS STRING)) END)"


@query("json_integers", JOURNAL_SQL + """, t AS (SELECT event_id, CASE WHEN k % 2 = 0 THEN -1 ELSE 1 END AS sign, CASE WHEN seller IS NULL THEN CAST(event_id AS HUGEINT) ELSE CAST(event_id AS HUGEINT) * 100 + k % 100 END AS digits,
  CASE WHEN price_raw IS NULL THEN 0 ELSE CAST(token_id AS INTEGER) % 24 - 3 END - CASE WHEN seller IS NULL THEN 0 ELSE 2 END AS power FROM j),
v AS (SELECT event_id, sign * CASE WHEN power >= 0 THEN digits * CAST(power(10::DOUBLE, power) AS HUGEINT) WHEN digits % CAST(power(10::DOUBLE, -power) AS HUGEINT) = 0 THEN digits // CAST(power(10::DOUBLE, -power) AS HUGEINT) END AS v FROM t)
SELECT event_id, CASE WHEN v BETWEEN -9223372036854775808 AND 9223372036854775807 THEN CAST(v AS VARCHAR) END AS value FROM v""")
def json_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal(spark, sf_dir).select("event_id", integer_text(F.expr(_TOKEN)).alias("value"))


_PART = '"itemType":2,"token":"t","identifierOrCriteria":"1","startAmount":"1","endAmount":"1"'
#: A listing's text from journal columns: quantities with a fraction, counters that are no numbers, unknown statuses, missing and repeated members.
_LISTING = f"""concat('{{"order_hash":"', coalesce(order_hash, ''), '","chain":"c","type":"basic","status":"', CASE event_type WHEN 'item_listed' THEN 'ACTIVE' WHEN 'item_sold' THEN 'FULFILLED' WHEN 'item_cancelled' THEN 'CANCELLED' WHEN 'order_invalidate' THEN 'INACTIVE' ELSE 'MOVED' END,
  '","remaining_quantity":', CAST(k AS STRING), CASE WHEN price_raw IS NULL THEN '.5' ELSE '' END, ',"protocol_address":"p","asset":{{"contract":"a"}},"price":{{"current":{{"currency":"E","decimals":18,"value":"', coalesce(price_raw, '0'), '"}}}},"protocol_data":{{"parameters":{{',
  CASE WHEN seller IS NULL THEN '' ELSE concat('"offerer":"', seller, '",') END, '"offer":[{{{_PART}}}],"consideration":[{{{_PART},"recipient":"r"}}],"startTime":"1","endTime":"2","orderType":0,"zone":"z","zoneHash":"h","salt":"1","conduitKey":"k","totalOriginalConsiderationItems":1,"counter":',
  CASE WHEN transaction_hash IS NOT NULL THEN concat('"0x', transaction_hash, '"') WHEN k % 2 = 0 THEN concat('"', order_hash, '"') ELSE token_id END, '}}}}', CASE WHEN event_version IS NULL THEN ',"chain":"d"' ELSE '' END, '}}')"""


@query("listing_admission", JOURNAL_SQL + """
SELECT event_id, event_type <> 'item_transferred' AND price_raw IS NOT NULL AND (transaction_hash IS NOT NULL OR k % 2 = 1) AND seller IS NOT NULL AND event_version IS NOT NULL AS admitted FROM j""")
def listing_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of listings, broken by what their events lack: a whole quantity, a counter, a status, the offerer, or one member too many."""
    return journal(spark, sf_dir).select("event_id", F.coalesce(admitted(F.expr(_LISTING)), F.lit(False)).alias("admitted"))
