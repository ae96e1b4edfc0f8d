"""A provider's events behind cursors, as a data source: one row a page, one partition a time window.

A window's pages follow from one another by cursors, so a window is read by
one task; a longer span is cut into windows, which are read side by side. The
transport is an object with ``page``; ``FolderProvider`` answers from a folder
of JSON lines by day, in any file system that Arrow knows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow.fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal
from tidemark.sources.staging import shared_folder

DAY = 86_400
PAGE_SCHEMA = "after bigint, before bigint, page_number int, cursor string, next_cursor string, page_sha256 string, n int, events array<string>, repeated boolean, outcome string"
#: How a scan of a window ends; only the first is complete.
EXHAUSTED, CYCLE, MOST_PAGES, MOST_EVENTS = "exhausted", "cursor cycle detected", "maxPages reached before exhaustion", "maxEvents reached before exhaustion"


@dataclass(frozen=True)
class Policy:
    """Bounds of a scan; the ranges that are allowed are those of the provider (fixed values)."""

    limit: int = 200
    max_pages: int = 100
    max_events: int = 20_000
    max_window_seconds: int = 7 * DAY

    def __post_init__(self) -> None:
        for name, most in (("limit", 200), ("max_pages", 1000), ("max_events", 100_000), ("max_window_seconds", 31 * DAY)):
            if not 1 <= getattr(self, name) <= most:
                raise ValueError(f"{name} must be from 1 to {most}")


def windows(after: int, before: int, step: int, policy: Policy = Policy()) -> list[tuple[int, int]]:
    """[after, before] in seconds, cut into windows of ``step`` seconds that share no second."""
    if not 0 <= after < before or step > policy.max_window_seconds:
        raise ValueError("a window needs after < before, and at most the policy's seconds")
    return [(at, min(at + step, before + 1) - 1) for at in range(after, before + 1, step)]


def checked_body(body: object) -> tuple[list, str | None]:
    """Events and next cursor of a response; an empty cursor is none."""
    if not isinstance(body, dict):
        raise ValueError("response is not an object")
    events = next((body[k] for k in ("asset_events", "events") if isinstance(body.get(k), list)), None)
    if events is None:
        raise ValueError("response has no event array")
    if not isinstance(body.get("next"), str | None):
        raise ValueError("next cursor is invalid")
    return events, body.get("next") or None


class FolderProvider:
    """Answers for a folder with ``day=<number>/*.json`` of events that have ``at`` (seconds), ``id`` and ``type``.

    Cursors are the number of events before the page. ``faults`` names days
    whose pages go round (``cycle``) or come twice (``repeat``), as providers' do.
    """

    def __init__(self, folder: str, faults: dict[str, str] | None = None) -> None:
        self.files, self.root = arrow_fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        self.faults, self.days = faults or {}, {}

    def _day(self, day: int) -> list[dict]:
        if day not in self.days:
            found = self.files.get_file_info(arrow_fs.FileSelector(f"{self.root}/day={day}", allow_not_found=True))
            lines = (line for f in found if f.base_name.endswith(".json") for line in self.files.open_input_file(f.path).read().decode().splitlines())
            self.days = {day: sorted(map(json.loads, lines), key=lambda e: (e["at"], e["id"]))}  # one day at a time
        return self.days[day]

    def page(self, after: int, before: int, limit: int, types: Sequence[str], cursor: str | None) -> object:
        start = int(cursor or 0)
        chosen = [e for day in range(after // DAY, before // DAY + 1) for e in self._day(day) if after <= e["at"] <= before and e["type"] in types]
        fault = self.faults.get(str(after // DAY))
        if fault == "repeat" and start >= limit:
            start -= limit
            following = str(start + 2 * limit) if start + 2 * limit < len(chosen) + limit else None
        else:
            following = str(start + limit) if start + limit < len(chosen) else None
        if fault == "cycle" and start >= 2 * limit:
            following = str(limit)
        return {"asset_events": chosen[start : start + limit], "next": following}


def scan(provider: FolderProvider, after: int, before: int, types: Sequence[str], policy: Policy) -> Iterator[tuple]:
    """Pages of one window until the provider has no more, its cursors go round, a cap is met, or an answer makes no sense.

    The last page's outcome says which; the others have none. Events beyond the cap are left out of its page.
    """
    cursors, hashes = set(), set()
    cursor, seen, number = None, 0, 0
    while True:
        try:
            events, following = checked_body(provider.page(after, before, policy.limit, types, cursor))
        except ValueError as e:
            yield after, before, number, cursor, None, None, 0, [], False, str(e)
            return
        taken = [json.dumps(e, sort_keys=True, separators=(",", ":")) for e in events[: policy.max_events - seen]]
        digest = hashlib.sha256("\n".join(taken).encode()).hexdigest()
        number, seen = number + 1, seen + len(taken)
        outcome = (
            EXHAUSTED if following is None else CYCLE if following in cursors else MOST_PAGES if number >= policy.max_pages else MOST_EVENTS if seen >= policy.max_events else None
        )
        yield after, before, number, cursor, following, digest, len(taken), taken, digest in hashes, outcome
        if outcome:
            return
        hashes.add(digest)
        cursors.add(following)
        cursor = following


class _Window(InputPartition):
    def __init__(self, after: int, before: int) -> None:
        self.after, self.before = after, before


class _PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options
        self.policy = Policy(**{k: int(options[k]) for k in ("limit", "max_pages", "max_events", "max_window_seconds") if k in options})
        self.span = windows(int(options["after"]), int(options["before"]), int(options.get("step", DAY)), self.policy)

    def partitions(self) -> list[InputPartition]:
        return [_Window(*w) for w in self.span]

    def read(self, partition: _Window) -> Iterator[tuple]:
        provider = FolderProvider(self.options["folder"], json.loads(self.options.get("faults", "{}")))
        return scan(provider, partition.after, partition.before, self.options["types"].split(","), self.policy)


class CursorPages(DataSource):
    """``spark.read.format("cursor_pages")`` with options folder, after, before, types, and those of ``Policy``."""

    @classmethod
    def name(cls) -> str:
        return "cursor_pages"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return _PageReader(dict(self.options))


def read_provider(spark: SparkSession, folder: str, after: int, before: int, types: Sequence[str], faults: dict[str, str] | None = None, **policy: int) -> DataFrame:
    """Pages of all windows from ``after`` to ``before``."""
    spark.dataSource.register(CursorPages)
    reader = spark.read.format("cursor_pages").option("folder", folder).option("after", after).option("before", before).option("types", ",".join(types)).option("faults", json.dumps(faults or {}))
    for name, value in policy.items():
        reader = reader.option(name, value)
    return reader.load()


def window_accounts(pages: DataFrame) -> DataFrame:
    """(after, pages, events, distinct_events, repeated_pages, outcome, complete) of each window; complete if exhausted without a repeated page."""
    ended = F.max("outcome")
    each = pages.groupBy("after").agg(F.count_if(F.col("page_number") > 0).alias("pages"), F.sum("n").alias("events"), F.count_if("repeated").alias("repeated_pages"), ended.alias("outcome"))
    ids = pages.select("after", F.explode("events").alias("e")).select("after", F.get_json_object("e", "$.id").alias("id")).groupBy("after").agg(F.count_distinct("id").alias("distinct_events"))
    sound = (F.col("outcome") == EXHAUSTED) & (F.col("repeated_pages") == 0)
    return each.join(ids, "after", "left").select("after", "pages", "events", F.coalesce("distinct_events", F.lit(0)).alias("distinct_events"), "repeated_pages", "outcome", sound.alias("complete"))


def land_provider(rows: DataFrame) -> tuple[str, int, int]:
    """Write journal rows as a provider's folder; gives the folder and the span of days that it covers."""
    folder = shared_folder(rows.sparkSession)
    at = F.expr("received_ms div 1000")
    rows.select(F.expr(f"received_ms div {DAY * 1000}").alias("day"), at.alias("at"), F.col("event_id").alias("id"), F.col("event_type").alias("type"), "token_id", "price_raw").write.partitionBy("day").json(folder)
    low, high = rows.agg(F.min(at), F.max(at)).first()
    return folder, low // DAY * DAY, high // DAY * DAY + DAY - 1


_TYPES, _LIMIT, _PAGES, _EVENTS = ("item_sold", "item_transferred"), 20, 40, 700


def _fault(day: int) -> str | None:
    return {3: "cycle", 5: "repeat"}.get(day % 7)


@query("provider_pages", JOURNAL_SQL + f""", e AS (SELECT event_id, received_ms // 1000 // {DAY} AS day, row_number() OVER (PARTITION BY received_ms // 1000 // {DAY} ORDER BY received_ms // 1000, event_id) - 1 AS place FROM j WHERE event_type IN {_TYPES}),
days AS (SELECT unnest(range(lo, hi + 1)) AS day FROM (SELECT min(received_ms // 1000 // {DAY}) AS lo, max(received_ms // 1000 // {DAY}) AS hi FROM j)),
n AS (SELECT day, count(event_id) AS n FROM days LEFT JOIN e USING (day) GROUP BY day),
-- pages by number: where each starts, and what comes next; a repeating provider answers every page after the first with the one before
p AS (SELECT day, n, p AS page, CASE WHEN day % 7 = 5 AND p > 1 THEN (p - 2) * {_LIMIT} ELSE (p - 1) * {_LIMIT} END AS start,
  CASE WHEN day % 7 = 3 AND p >= 3 THEN {_LIMIT} WHEN day % 7 = 5 AND p > 1 THEN CASE WHEN p * {_LIMIT} < n + {_LIMIT} THEN p * {_LIMIT} END WHEN p * {_LIMIT} < n THEN p * {_LIMIT} END AS following
  FROM n, unnest(range(1, {_PAGES} + 1)) AS u(p)),
counted AS (SELECT *, least(greatest(n - start, 0), {_LIMIT}) AS full_size, sum(least(greatest(n - start, 0), {_LIMIT})) OVER (PARTITION BY day ORDER BY page ROWS UNBOUNDED PRECEDING) AS upto FROM p),
ends AS (SELECT *, CASE WHEN following IS NULL THEN '{EXHAUSTED}' WHEN day % 7 = 3 AND page >= 3 THEN '{CYCLE}' WHEN page >= {_PAGES} THEN '{MOST_PAGES}' WHEN upto >= {_EVENTS} THEN '{MOST_EVENTS}' END AS outcome FROM counted),
last_page AS (SELECT day, min(page) AS pages FROM ends WHERE outcome IS NOT NULL GROUP BY day),
read_ AS (SELECT c.*, full_size - greatest(upto - {_EVENTS}, 0) AS size FROM ends c JOIN last_page l ON l.day = c.day AND c.page <= l.pages),
distinct_ AS (SELECT r.day, count(DISTINCT event_id) AS distinct_events FROM read_ r JOIN e ON e.day = r.day AND e.place >= r.start AND e.place < r.start + r.size GROUP BY r.day),
told AS (SELECT r.day, max(page) AS pages, CAST(sum(size) AS BIGINT) AS events, count(*) - count(DISTINCT start || ':' || size) AS repeated_pages, max(outcome) AS outcome FROM read_ r GROUP BY r.day)
SELECT day * {DAY} AS after, pages, events, coalesce(distinct_events, 0) AS distinct_events, repeated_pages, outcome, outcome = '{EXHAUSTED}' AND repeated_pages = 0 AS complete FROM told LEFT JOIN distinct_ USING (day)""")
def provider_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day's sales and transfers, read from a provider some of whose days go round or repeat a page: what each scan got."""
    folder, after, before = land_provider(journal(spark, sf_dir))
    faults = {str(day): f for day in range(after // DAY, before // DAY + 1) if (f := _fault(day))}
    return window_accounts(read_provider(spark, folder, after, before, _TYPES, faults, limit=_LIMIT, max_pages=_PAGES, max_events=_EVENTS))
