"""Turns of a budget and commits inside a run, by a clock that the fetches move."""

import pytest

from parchment.cli import UNITS
from parchment.plans.budget import sync_in_slices, turns, waiting_order
from parchment.plans.runner import Run
from parchment.plans.store import SnapshotStore
from parchment.plans.sync import Options
from parchment.sources.http import Response
from test_run import Site, read_pdf


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now


def test_turns_keep_a_reserve_and_hand_on_what_is_left():
    clock, seen = Clock(), []
    for name, deadline in turns("abc", 100, 20, clock):
        seen.append((name, deadline))
        clock.now += {"a": 30, "b": 45, "c": 1}[name]
    assert seen == [("a", 60), ("b", 80), ("c", 100)]
    clock, seen = Clock(), []
    for name, deadline in turns("abcd", 100, 20, clock):  # a takes far longer than it may
        seen.append((name, deadline))
        clock.now += 75 if name == "a" else 20
    assert seen == [("a", 40), ("b", 95), ("c", 100)]
    assert list(turns("ab", 10, 60, Clock())) == [("a", 5), ("b", 10)] and list(turns("", 10, 1, Clock())) == []


def test_who_waits_longest_comes_first():
    whole = lambda at, stopped=None: {"listing": {"at": at}, "runs": [{"stopped": stopped}]}
    assert waiting_order({"a": whole("2"), "b": whole("1"), "c": whole("3", "budget"), "d": {"listing": None, "runs": []}}) == ["d", "c", "b", "a"]


class Slow(Site):
    """Every answer takes ten seconds."""

    def client(self):
        got = super().client()
        send = got.send

        def later(method, url, headers):
            self.now += 10
            return send(method, url, headers)

        got.send = later
        return got


@pytest.fixture
def setting(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    site = Slow({f"https://h/{i}": b"%PDF-" + i.encode() for i in "abcde"} | {"https://h/x": Response(404, {}, b"")})
    units = spark.createDataFrame([(i, f"https://h/{i}", "OT1" if i < "d" else "OT2", 2020, None, None, i, "[]", "pdf") for i in "abcdex"], UNITS)
    return store, site, units


def go(setting, now, deadline=float("inf"), every=25.0, room=lambda: True, **options):
    store, site, units = setting
    run = Run(now=now, deadline=deadline, clock=lambda: site.now, room=room)
    site.asked.clear()
    manifest = sync_in_slices(store, units, site.client(), run, Options(now=now.replace("T", " "), current_term=2025, **options), every, read_pdf=read_pdf)
    return run, manifest


def test_a_run_commits_on_the_way_and_asks_once(setting):
    store, site, _ = setting
    run, manifest = go(setting, "2026-09-01T00:00:00")
    gets = [u for m, u in site.asked]
    assert len(gets) == len(set(gets)) == 6 and run.stopped is None and run.slices == manifest["version"] > 1
    assert (run.counts["added"], run.counts["failed"], manifest["failures"]["x"]["attempts"]) == (5, 1, 1)
    assert manifest["listing"]["count"] == 6 and [r["stopped"] for r in manifest["runs"]][-2:] == ["checkpoint", None]
    rows = [store.read(manifest=store.manifest(v)).count() for v in store.versions()]
    assert rows == sorted(rows) and 0 < rows[0] < rows[-1] == 5  # each commit holds what had come
    # everything is fetched again, each file once
    run, _ = go(setting, "2026-09-02T00:00:00", refetch=True)
    gets = [u for m, u in site.asked]
    assert len(gets) == len(set(gets)) == 6 and run.counts["unchanged"] == 5 and run.slices > 1


def test_budget_and_room_stop_a_run(setting):
    store, site, _ = setting
    run, manifest = go(setting, "2026-09-01T00:00:00", deadline=35)
    assert run.stopped == "budget" and manifest["listing"] is None and 0 < store.read().count() < 5
    had = store.read().count()
    run, manifest = go(setting, "2026-09-02T00:00:00", room=lambda: False)
    assert run.stopped == "no room" and store.read().count() == had and not site.asked
    run, manifest = go(setting, "2026-09-03T00:00:00", every=float("inf"))
    assert run.slices == 1 and store.read().count() == 5
