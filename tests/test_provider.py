import json

import pytest

from tests.compare import assert_same, database
from tidemark.plans.registry import ORACLES, QUERIES
from tidemark.sources import provider as P


class Listed:
    """A provider of ``n`` events on one day whose answers can be replaced."""

    def __init__(self, n, answers=None):
        self.events, self.answers = [{"id": i} for i in range(n)], answers or {}

    def page(self, after, before, limit, types, cursor):
        start = int(cursor or 0)
        return self.answers.get(start, {"asset_events": self.events[start : start + limit], "next": str(start + limit) if start + limit < len(self.events) else None})


def ends(provider, **policy):
    pages = list(P.scan(provider, 0, 9, ["t"], P.Policy(**policy)))
    assert all(p[-1] is None for p in pages[:-1])
    return len(pages), sum(p[6] for p in pages), pages[-1][-1], [p[-2] for p in pages]


def test_a_scan_ends_as_the_provider_or_the_caps_say():
    assert ends(Listed(5), limit=2) == (3, 5, P.EXHAUSTED, [False] * 3)
    assert ends(Listed(0)) == (1, 0, P.EXHAUSTED, [False])
    assert ends(Listed(50), limit=2, max_pages=3) == (3, 6, P.MOST_PAGES, [False] * 3)
    assert ends(Listed(50), limit=4, max_events=6) == (2, 6, P.MOST_EVENTS, [False] * 2)
    assert ends(Listed(9, {4: {"events": [{"id": 4}], "next": "2"}}), limit=2)[2] == P.CYCLE
    assert ends(Listed(4, {2: {"events": [{"id": 0}, {"id": 1}], "next": ""}}), limit=2) == (2, 4, P.EXHAUSTED, [False, True])


@pytest.mark.parametrize(("body", "error"), [([], "not an object"), ({"next": None}, "no event array"), ({"events": [], "next": 3}, "cursor is invalid")])
def test_bodies_without_sense_end_a_scan(body, error):
    pages, _, outcome, _ = ends(Listed(9, {2: body}), limit=2)
    assert pages == 2 and error in outcome


def test_windows_share_no_second_and_keep_the_policy():
    assert P.windows(0, 9, 4) == [(0, 3), (4, 7), (8, 9)]
    for bad in ((5, 5, 1), (0, 10, 8 * P.DAY), (-1, 4, 1)):
        with pytest.raises(ValueError, match="window"):
            P.windows(*bad)
    for bad in ({"limit": 201}, {"max_pages": 0}, {"max_events": 100_001}, {"max_window_seconds": 32 * P.DAY}):
        with pytest.raises(ValueError, match="must be"):
            P.Policy(**bad)


def test_source_reads_a_folder_by_windows(spark, tmp_path):
    for day in (0, 1):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "x.json").write_text("\n".join(json.dumps({"at": day * P.DAY + i, "id": day * 100 + i, "type": "a" if i % 2 else "b"}) for i in range(10)))
    pages = P.read_provider(spark, str(tmp_path), 0, 3 * P.DAY - 1, ["a"], limit=2)
    assert pages.rdd.getNumPartitions() == 3
    told = {r["after"] // P.DAY: (r["pages"], r["events"], r["outcome"]) for r in P.window_accounts(pages).collect()}
    assert told == {0: (3, 5, P.EXHAUSTED), 1: (3, 5, P.EXHAUSTED), 2: (1, 0, P.EXHAUSTED)}


def test_caps_are_met_at_a_larger_size(spark):
    folder = "/root/testdata/sf0.1"
    assert_same(QUERIES["provider_pages"](spark, folder), database(folder), ORACLES["provider_pages"])
