"""Raw stream events, as JSON text, to normalised rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import normalise as N
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal

ORDER_FAMILIES = ("item_listed", "item_cancelled", "item_sold", "order_invalidate", "order_revalidate")
ZERO = "0x" + "0" * 40
#: Families that each capture profile asks for.
PROFILES = {"all": (*ORDER_FAMILIES, "item_transferred"), "orders": ORDER_FAMILIES, "transfers": ("item_transferred",)}


_ADDRESS, _TEXTS = "struct<address:string>", lambda *names: ",".join(f"{n}:string" for n in names)
#: The fields that are read, all as text, so that numbers stay as written.
EVENT = (
    f"event_type string, version string, payload struct<{_TEXTS('event_timestamp', 'order_hash', 'base_price', 'sale_price', 'listing_date', 'expiration_date', 'transaction_hash')},"
    f"item:struct<nft_id:string,permalink:string,metadata:struct<name:string>>,maker:{_ADDRESS},taker:{_ADDRESS},from_account:{_ADDRESS},to_account:{_ADDRESS},"
    f"payment_token:struct<{_TEXTS('address', 'decimals', 'symbol')}>,transaction:struct<hash:string,timestamp:string>,"
    "protocol_data:struct<parameters:struct<offerer:string,offer:array<struct<token:string,identifierOrCriteria:string>>>>>"
)


def captured(rows: DataFrame, profile: str) -> DataFrame:
    return rows.where(F.col("event_type").isin(*PROFILES[profile]))


def transfer_hint(family: Column, source: Column, target: Column) -> Column:
    """What kind of transfer the ends suggest; null for an event that is none and has no ends."""
    return (
        F.when(F.lower(source) == ZERO, "zero_source").when(F.lower(target) == ZERO, "zero_destination")
        .when(source.isNotNull() & target.isNotNull(), "wallet_to_wallet").when(family == "item_transferred", "unknown")
    )


def normalise_events(rows: DataFrame, text: str) -> DataFrame:
    """Order and transfer events with checked fields, and what is odd about each.

    ``rows`` keeps its other columns. An unsupported family gives a row with a
    null event_type. Issues make an event suspicious: a listing whose asset or
    maker disagrees with the signed offer, or a version that is no safe integer
    (a missing one is none). A revalidation is always suspicious and carries no
    seller, price or time bounds. A sale is priced by its sale price.
    """
    parsed = rows.withColumn("_event", F.from_json(text, EVENT))  # once for all fields
    at = lambda path: N.non_empty(F.col(f"_event.payload.{path}"))
    kind = F.col("_event.event_type")
    family = F.when(kind.isin(*PROFILES["all"]), kind)
    listed, transfer, revalidate = family == "item_listed", family == "item_transferred", family == "order_revalidate"
    nft, version = at("item.nft_id"), F.col("_event.version")
    contract, token = N.nft_part(nft, 2), N.nft_part(nft, 3)
    offer = F.get("_event.payload.protocol_data.parameters.offer", 0)
    maker, offerer = at("maker.address"), at("protocol_data.parameters.offerer")
    issues = F.array_compact(F.array(
        F.when(listed & (F.lower(offer["token"]) != contract), F.lit("nft_contract_disagrees_with_protocol_offer")),
        F.when(listed & (offer["identifierOrCriteria"] != token), F.lit("nft_token_disagrees_with_protocol_offer")),
        F.when(~transfer & (F.lower(maker) != F.lower(offerer)), F.lit("maker_disagrees_with_protocol_offerer")),
        F.when(~transfer & version.isNotNull() & N.event_version(version).isNull(), F.lit("event_version_invalid_or_unsafe")),
        F.when(revalidate, F.lit("order_revalidate_unverified")),
    ))
    amount = F.when(family == "item_sold", at("sale_price")).otherwise(at("base_price"))
    decimals = at("payment_token.decimals").try_cast("int")
    plain = ~transfer & ~revalidate
    fields = {
        "event_type": family,
        "event_ms": N.business_ms(at("event_timestamp")),
        "event_version": N.event_version(version),
        "order_hash": F.when(~transfer, at("order_hash")),
        "nft_id": F.when(contract.isNotNull(), nft),
        "chain": N.nft_part(nft, 1),
        "contract_address": contract,
        "token_id": token,
        "seller": F.when(plain, maker),
        "buyer_candidate": F.when(plain, at("taker.address")),
        "price_raw": F.when(plain & N.decimal_text(amount, decimals).isNotNull(), amount),
        "price": F.when(plain, N.decimal_text(amount, decimals)),
        "token_address": F.when(plain, F.lower(at("payment_token.address"))),
        "listing_ms": F.when(plain, N.business_ms(at("listing_date"))),
        "expiration_ms": F.when(plain, N.business_ms(at("expiration_date"))),
        "item_name": at("item.metadata.name"),
        "permalink": at("item.permalink"),
        "transaction_hash": F.coalesce(at("transaction.hash"), F.when(~transfer, at("transaction_hash"))),
        "transaction_ms": F.when(transfer, N.business_ms(at("transaction.timestamp"))),
        "from_address": F.when(transfer, at("from_account.address")),
        "to_address": F.when(transfer, at("to_account.address")),
        "issues": F.array_join(issues, ","),
    }
    out = parsed.select(*rows.columns, *(F.when(family.isNotNull(), c).alias(n) for n, c in fields.items()))
    return out.withColumn("suspicious", F.col("issues") != "").withColumn("transfer_hint", transfer_hint(F.col("event_type"), F.col("from_address"), F.col("to_address")))


def raw_events(rows: DataFrame) -> DataFrame:
    """(event_id, raw): the journal as it would have come from the stream."""
    k, family = F.col("k"), F.col("event_type")
    iso = F.expr("date_format(timestampadd(MILLISECOND, event_ms, TIMESTAMP_NTZ '1970-01-01 00:00:00'), \"yyyy-MM-dd'T'HH:mm:ss'.000Z'\")")
    offer = F.struct(F.when(k % 19 == 3, "0xOTHER").otherwise("0xC").alias("token"), F.when(k % 23 == 4, "999999999").otherwise(F.col("token_id")).alias("identifierOrCriteria"))
    parameters = F.struct(F.when(k % 29 == 5, "someone").otherwise(F.upper("seller")).alias("offerer"), F.array(offer).alias("offer"))
    address = lambda c: F.struct(F.col(c).alias("address"))
    payload = F.struct(
        iso.alias("event_timestamp"), "order_hash", F.struct("nft_id", F.struct(F.concat(F.lit("Item "), "token_id").alias("name")).alias("metadata")).alias("item"), address("seller").alias("maker"),
        F.when(family != "item_sold", F.col("price_raw")).alias("base_price"), F.when(family == "item_sold", F.col("price_raw")).alias("sale_price"), F.struct(F.lit(18).alias("decimals"), F.lit("0xTOKEN").alias("address")).alias("payment_token"),
        F.expr("cast(expiration_ms div 1000 AS string)").alias("expiration_date"), F.struct(F.col("transaction_hash").alias("hash")).alias("transaction"),
        address("from_address").alias("from_account"), address("to_address").alias("to_account"), F.struct(parameters.alias("parameters")).alias("protocol_data"),
    )
    version = F.when(k % 31 == 6, F.lit("1.5")).otherwise(F.col("event_version").cast("string"))
    return rows.select("event_id", F.to_json(F.struct(F.when(k % 37 == 7, "item_offered").otherwise(family).alias("event_type"), version.alias("version"), payload.alias("payload"))).alias("raw"))


@query("stream_normalisation", JOURNAL_SQL + """, kept AS (SELECT *, event_type = 'item_transferred' AS moved FROM j)
SELECT event_id, CASE WHEN k % 37 <> 7 THEN event_type END AS event_type, CASE WHEN k % 37 <> 7 THEN event_ms END AS event_ms, CASE WHEN k % 37 <> 7 AND k % 31 <> 6 THEN event_version END AS event_version,
       CASE WHEN k % 37 <> 7 THEN order_hash END AS order_hash, CASE WHEN k % 37 <> 7 THEN contract_address END AS contract_address, CASE WHEN k % 37 <> 7 AND NOT moved THEN seller END AS seller,
       CASE WHEN k % 37 <> 7 AND NOT moved AND price_raw IS NOT NULL THEN CASE WHEN price_raw = '0' || repeat('0', 16) THEN '0.0' ELSE
         CASE WHEN length(price_raw) > 18 THEN left(price_raw, length(price_raw) - 18) ELSE '0' END || '.' || coalesce(nullif(rtrim(right(repeat('0', 18) || price_raw, 18), '0'), ''), '0') END END AS price,
       CASE WHEN k % 37 <> 7 AND NOT moved THEN expiration_ms END AS expiration_ms, CASE WHEN k % 37 <> 7 THEN transaction_hash END AS transaction_hash, CASE WHEN k % 37 <> 7 AND moved THEN 'wallet_to_wallet' END AS transfer_hint,
       CASE WHEN k % 37 <> 7 THEN array_to_string(list_filter([CASE WHEN event_type = 'item_listed' AND k % 19 = 3 THEN 'nft_contract_disagrees_with_protocol_offer' END,
         CASE WHEN event_type = 'item_listed' AND k % 23 = 4 THEN 'nft_token_disagrees_with_protocol_offer' END, CASE WHEN NOT moved AND k % 29 = 5 AND seller IS NOT NULL THEN 'maker_disagrees_with_protocol_offerer' END,
         CASE WHEN NOT moved AND k % 31 = 6 THEN 'event_version_invalid_or_unsafe' END], lambda x: x IS NOT NULL), ',') END AS issues
FROM kept""")
def stream_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["event_id", "event_type", "event_ms", "event_version", "order_hash", "contract_address", "seller", "price", "expiration_ms", "transaction_hash", "transfer_hint", "issues"]
    return normalise_events(raw_events(journal(spark, sf_dir)), "raw").select(*columns)
