import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions import normalise as N


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "none string"
    return spark.createDataFrame([tuple(values.values()) or (None,)], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "decimals", "expected"),
    [("16000000000000000000000", 18, "16000.0"), ("123", 2, "1.23"), ("007", 5, "0.00007"), ("5", 0, "5"), ("000", 0, "0"), ("0", 3, "0.0"), ("12x", 2, None), ("", 2, None), ("1", -1, None), ("9" * 78, 18, "9" * 60 + "." + "9" * 18)],
)
def test_decimal_text(spark, raw, decimals, expected):
    assert one(spark, N.decimal_text(F.col("raw"), F.col("d")), raw=raw, d=decimals) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("1700000000", 1_700_000_000_000), ("1700000000123", 1_700_000_000_123), (" 2024-01-02T03:04:05.6789Z ", 1_704_164_645_678), ("2024-01-02T03:04:05Z", 1_704_164_645_000), ("946684800", 946_684_800_000),
     ("12", None), ("01700000000", None), ("2024-01-02 03:04:05Z", None), ("2024-13-02T03:04:05Z", None), ("", None), ("-5", None), ("99999999999999999999", None)],
)
def test_business_ms(spark, value, expected):
    assert one(spark, N.business_ms(F.col("v")), v=value) == expected


@pytest.mark.parametrize(("value", "expected"), [("0", 0), ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("01", None), ("-1", None), ("1e3", None)])
def test_event_version(spark, value, expected):
    assert one(spark, N.event_version(F.col("v")), v=value) == expected


def test_nft_parts_keep_case_but_for_the_contract(spark):
    parts = [one(spark, N.nft_part(F.col("v"), i), v="Chain/0xAB/007") for i in (1, 2, 3)]
    assert parts == ["Chain", "0xab", "007"]
    assert one(spark, N.nft_part(F.col("v"), 1), v="chain/0xab") is None


def test_uint256_bound(spark):
    assert one(spark, N.fits_uint256(F.col("v")), v=str(2**256 - 1))
    assert not one(spark, N.fits_uint256(F.col("v")), v=str(2**256))
    assert not one(spark, N.fits_uint256(F.col("v")), v="-1")


def test_redaction_and_codes(spark):
    shown = one(spark, N.redact(F.col("v")), v="token = abc, at https://user:pw@host/x API-KEY=zz")
    assert shown == "token=<REDACTED>, at https://<REDACTED>@host/x API-KEY=<REDACTED>"
    assert len(one(spark, N.redact(F.col("v")), v="x" * 900)) == 500
    assert one(spark, N.sanitise_code(F.col("v")), v="a b/c") == "a_b_c"
    assert one(spark, N.sanitise_code(F.col("v")), v="") == "unknown_error"


def test_dedupe_key_is_a_hash_of_canonical_json(spark):
    parts = [("eventType", F.lit("item_transferred")), ("chain", F.lit('q"uote')), ("nftId", F.lit("c/0x1/2"))]
    text = '{"components":{"chain":"q\\"uote","eventType":"item_transferred","nftId":"c/0x1/2"},"family":"transfer","schema":"layout","version":1}'
    assert one(spark, N.dedupe_key("transfer", parts, "layout")) == "transfer:v1:" + hashlib.sha256(text.encode()).hexdigest()


def test_backoff_doubles_up_to_its_limit(spark):
    assert [one(spark, N.backoff_ms(F.lit(n))) for n in (1, 2, 7, 60)] == [5_000, 10_000, 300_000, 300_000]


def test_lock_bucket_is_signed(spark):
    digest = int(hashlib.sha256(b"order").hexdigest()[:16], 16)
    assert one(spark, N.lock_bucket(F.col("v")), v="order") == (digest - 2**64 if digest >= 2**63 else digest)


def test_reasons_are_sorted_and_distinct(spark):
    assert one(spark, N.reasons(("B", F.lit(True)), ("A", F.lit(True)), ("C", F.lit(None).cast("boolean")), ("B", F.lit(True)))) == "A,B"


def test_attempt_ids_and_jitter(spark):
    ids = ["123e4567-e89b-12d3-a456-426614174000", "123E4567-e89b-12d3-a456-426614174000", "123e4567e89b12d3a456426614174000", None]
    rows = spark.createDataFrame([(i,) for i in ids], "x string")
    assert [r["v"] for r in rows.select(N.is_attempt_id(F.col("x")).alias("v")).collect()] == [True, False, False, False]
    delays = spark.range(1).select(*(N.backoff_ms(F.lit(n), jitter=F.lit(j)).alias(f"d{n}_{j}") for n, j in ((1, 0), (1, 50), (2, 100), (9, 100)))).first()
    assert tuple(delays) == (5_000, 5_500, 12_000, 300_000)
