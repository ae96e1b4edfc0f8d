"""Scalar rules on event fields as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NFT_ID = r"^([^/]+)/([^/]+)/([0-9]+)$"
#: Business times lie between these, in seconds (2000-01-01 and 2100-01-01).
FIRST_SECOND, LAST_SECOND = 946_684_800, 4_102_444_800
LARGEST_BIGINT = "9223372036854775807"
#: Identities of orders, accounts, tokens and digests (fixed formats).
ORDER_HASH, ADDRESS, TOKEN, DIGEST = r"^0x[0-9a-f]{64}$", r"^0x[0-9a-f]{40}$", r"^(0|[1-9][0-9]*)$", r"^[0-9a-f]{64}$"
INTEGER, ISO_TIME = r"^(0|[1-9][0-9]*)$", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"


def nft_part(nft_id: Column, part: int) -> Column:
    """Chain (1), contract in lower case (2) or token (3) of ``chain/contract/token``, or null."""
    found = F.when(nft_id.rlike(NFT_ID), F.regexp_extract(nft_id, NFT_ID, part))
    return F.lower(found) if part == 2 else found


def non_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def decimal_text(raw: Column, decimals: Column) -> Column:
    """Exact decimal string of an integer string shifted by ``decimals`` places; null if either is invalid.

    No zeros in front or behind, and one digit after the point at least unless
    ``decimals`` is 0. Works on any number of digits.
    """
    digits = F.regexp_replace(raw, r"^0+(?=\d)", "")
    width = F.greatest(F.length(digits), decimals + 1)
    padded = F.lpad(digits, width, "0")
    whole = F.substr(padded, F.lit(1), width - decimals)
    fraction = F.regexp_replace(F.substr(padded, width - decimals + 1, decimals), "0+$", "")
    shifted = F.when(decimals == 0, digits).otherwise(F.concat(whole, F.lit("."), F.coalesce(non_empty(fraction), F.lit("0"))))
    return F.when(raw.rlike("^[0-9]+$") & (decimals >= 0), shifted)


def event_version(value: Column) -> Column:
    """Canonical non-negative integer text as BIGINT, null if it is none or too large."""
    return F.when(value.rlike(INTEGER), value.try_cast("long"))


def compare_versions(a: Column, b: Column) -> Column:
    """-1, 0 or 1; null if either is null."""
    return F.when(a < b, -1).when(a == b, 0).when(a > b, 1)


def business_ms(value: Column) -> Column:
    """Milliseconds of a business time given as epoch seconds, epoch milliseconds or ISO text, else null."""
    text = F.trim(value)
    number = F.when(text.rlike(INTEGER), text.try_cast("long"))
    # ISO digits are read field by field, so the session's time zone plays no part
    clean = F.regexp_replace(F.regexp_replace(text, "T", " "), r"(\.\d{1,6})\d*Z$|Z$", "$1")
    iso = F.when(text.rlike(ISO_TIME), _iso_ms(clean))
    inside = lambda x: F.when(x.between(FIRST_SECOND * 1000, LAST_SECOND * 1000), x)
    seconds = F.when(number.between(FIRST_SECOND, LAST_SECOND), number * 1000)
    return F.coalesce(seconds, inside(number), inside(iso)).cast("long")


def _iso_ms(clean: Column) -> Column:
    moment = clean.try_cast("timestamp_ntz")
    days = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    micros = F.round(F.extract(F.lit("SECOND"), moment) * 1000, 6)
    return days * 86_400_000 + F.hour(moment) * 3_600_000 + F.minute(moment) * 60_000 + F.floor(micros).cast("long")


def floor_second(ms: Column) -> Column:
    return ms - F.pmod(ms, F.lit(1000))


def dedupe_key(family: str, parts: list[tuple[str, Column]], schema: str = "tidemark-dedupe") -> Column:
    """``family:v1:`` and the SHA-256 of canonical JSON (sorted keys) of the parts.

    ``schema`` names the layout inside the hashed text; keys of another system
    are met by its name.
    """
    members = F.to_json(F.struct(*(value.alias(name) for name, value in sorted(parts, key=lambda p: p[0]))), {"ignoreNullFields": "false"})
    text = F.concat(F.lit('{"components":'), members, F.lit(f',"family":"{family}","schema":"{schema}","version":1}}'))
    return F.concat(F.lit(f"{family}:v1:"), F.sha2(text, 256))


def redact(message: Column, most: int = 500) -> Column:
    """Values of secrets and the credentials of URLs are blanked, then the text is cut."""
    shown = F.regexp_replace(message, r"(?i)\b(password|token|secret|api[_-]?key)\s*=\s*[^,\s]+", "$1=<REDACTED>")
    shown = F.regexp_replace(shown, r"://[^/\s:@]+:[^/\s@]+@", "://<REDACTED>@")
    return F.substring(shown, 1, most)


def sanitise_code(code: Column) -> Column:
    return F.substring(F.regexp_replace(F.coalesce(non_empty(code), F.lit("unknown_error")), r"[^A-Za-z0-9_.-]", "_"), 1, 80)


def lock_bucket(name: Column) -> Column:
    """Signed 64-bit number from the first 16 hex digits of a SHA-256."""
    return F.conv(F.substring(F.sha2(name, 256), 1, 16), 16, -10).cast("long")


def backoff_ms(attempt: Column, base: int = 5_000, most: int = 300_000, jitter: Column | None = None, percent: int = 20) -> Column:
    """Delay before the next attempt: doubles with each, up to a limit.

    ``jitter`` (0 to 100) adds that part of ``percent`` of the delay, within the limit; as a column it may be a hash of
    the row, so that a repeated run gives the same times.
    """
    delay = F.least(F.lit(base) * F.pow(F.lit(2), F.least(attempt - 1, F.lit(30))), F.lit(most)).cast("long")
    return delay if jitter is None else F.least(delay + F.floor(delay * jitter * percent / 10_000), F.lit(most)).cast("long")


def is_attempt_id(value: Column) -> Column:
    """Whether text is a UUID in its canonical form; false for null."""
    return F.coalesce(value.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[1-8][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"), F.lit(False))


def fits_uint256(value: Column) -> Column:
    """Whether integer text lies below 2**256; compared as padded text, as no number type holds it."""
    digits = F.regexp_replace(value, r"^0+(?=\d)", "")
    return value.rlike("^[0-9]+$") & (F.length(digits) <= 78) & (F.lpad(digits, 78, "0") <= F.lit(str(2**256 - 1).zfill(78)))


def identity_status(order_hash: Column, contract: Column, token: Column, chain: Column, chains: tuple[str, ...]) -> Column:
    """VALID, INVALID_LOCAL_IDENTITY or UNSUPPORTED_LOCAL_SCOPE."""
    formed = order_hash.rlike(ORDER_HASH) & contract.rlike(ADDRESS) & token.rlike(TOKEN)
    return F.when(~F.coalesce(formed, F.lit(False)), "INVALID_LOCAL_IDENTITY").when(~chain.isin(*chains), "UNSUPPORTED_LOCAL_SCOPE").otherwise("VALID")


def reasons(*checks: tuple[str, Column]) -> Column:
    """Sorted distinct names of the checks that hold, joined by commas; empty if none does."""
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in checks))))), ",")
