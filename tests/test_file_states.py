"""The stream of listings against the batch plan, with a restart in the middle, late links and waits after failures."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from parchment.plans.sync import Options, sync_plan
from parchment.streaming import file_states
from parchment.streaming.file_states import ENDED, EVENTS, FAILED, LISTED, STORED, File

START = datetime(2026, 9, 1)
ACTIONS = ("fetch", "skip", "delist", "relist", "update")
UNIT, STORED_ROW, FAILURE = "id string, partition string, title string", "id string, partition string, title string, listed boolean, term int", "id string, attempts int, at timestamp_ntz"


def time_of(run):
    return START + timedelta(hours=20 * run)


def made(runs):
    """Links by run, and outcomes by run: most files come, change, go and fail now and then."""
    rng, links, outcomes = random.Random(5), [], []
    for r in range(runs):
        links.append([(f"f{i}", f"OT{rng.randrange(3)}", rng.choice("ab")) for i in range(30) for _ in range(rng.choice((0, 1, 1, 2)))])
        outcomes.append([(rng.choice((FAILED, FAILED, STORED)), f"f{i}") for i in rng.sample(range(32), 12)])
    return links, outcomes


def batch_plans(spark, links, outcomes):
    """(run, id, partition, action) and the stored rows by repeating sync_plan over tables, and what each run's outcomes make of them."""
    stored, failures, seen = {}, {}, set()
    for r, found in enumerate(links):
        units = {}
        for uid, partition, title in found:
            units[uid] = (min(units[uid][0], partition), units[uid][1]) if uid in units else (partition, title)
        plan = sync_plan(
            spark.createDataFrame([(k, *v) for k, v in units.items()], UNIT), spark.createDataFrame([(k, *v, 2020) for k, v in stored.items()], STORED_ROW),
            spark.createDataFrame([(k, *v) for k, v in failures.items()], FAILURE), Options(now=str(time_of(r)), current_term=2025),
        )
        for row in plan.collect():
            seen |= {(r, row.id, row.partition, a) for a in ACTIONS if row[a]}
            if row.delist:
                stored[row.id] = (*stored[row.id][:2], False)
            if row.relist or row.update:
                stored[row.id] = (stored[row.id][0], units[row.id][1], True)
        failures = {k: v for k, v in failures.items() if k in units}
        for kind, uid in outcomes[r]:
            if kind == FAILED:
                failures[uid] = (failures.get(uid, (0,))[0] + 1, time_of(r))
            else:
                failures.pop(uid, None)
                old = stored.get(uid, (f"home of {uid}", None, None))
                stored[uid] = (old[0], units[uid][1] if uid in units else old[1], uid in units)
    return seen, stored, failures


def events_of(links, outcomes, r):
    at = time_of(r)
    yield from ((LISTED, r, n, at, *x) for n, x in enumerate(links[r]))
    yield (ENDED, r, None, at, None, None, None)
    yield from ((kind, r, n, at, uid, f"home of {uid}", None) for n, (kind, uid) in enumerate(outcomes[r]))


def add(spark, folder, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def go(spark, tmp_path, buckets=5):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/events")
    file_states.run(stream, f"{tmp_path}/actions", f"{tmp_path}/checkpoint", buckets).awaitTermination()
    return spark.read.schema(file_states.ACTIONS).parquet(f"{tmp_path}/actions")


def test_the_stream_ends_where_the_batch_plan_does(spark, tmp_path):
    links, outcomes = made(6)
    want, stored, failures = batch_plans(spark, links, outcomes)
    rows = [list(events_of(links, outcomes, r)) for r in range(6)]
    add(spark, f"{tmp_path}/events", [*rows[0], *rows[1], *rows[2], *rows[3][:9]])  # several runs in one batch, and the start of another
    go(spark, tmp_path)
    add(spark, f"{tmp_path}/events", [*rows[3][9:], *rows[4]])
    add(spark, f"{tmp_path}/events", [*rows[5], *rows[2][-13:-12], (None, 1, 1, START, "x", "p", "l"), (LISTED, 1, 1, START, None, "p", "l")])  # an end again, and rows that say nothing
    got = go(spark, tmp_path).where("action <> 'retry'")
    seen = [(x.run, x.id, x.partition, x.action) for x in got.collect()]
    assert len(seen) == len(set(seen)) and set(seen) == want and {a for *_, a in want} == set(ACTIONS)
    states = {x.id: x for x in file_states.states(spark, f"{tmp_path}/checkpoint").collect()}
    assert {k: (x.home, x.kept, x.listed) for k, x in states.items() if x.known} == stored
    assert {k: x.attempts for k, x in states.items() if x.attempts} == {k: n for k, (n, _) in failures.items()}
    live = {u for u, *_ in links[5]}
    assert set(states) == set(stored) | set(failures) | live  # files that are neither listed nor stored are forgotten


def test_a_timer_ends_a_wait(spark, tmp_path):
    long_ago, now = datetime(2024, 1, 1), datetime.now()
    failed = lambda uid, at: [(FAILED, 0, n, at, uid, "p", None) for n in range(3)]
    listed = [(LISTED, 0, n, long_ago, uid, "p", "l") for n, uid in enumerate("abc")]
    tick = lambda n: add(spark, f"{tmp_path}/events", [(LISTED, 1, n, now, "other", "p", "l")])
    add(spark, f"{tmp_path}/events", [*listed, (ENDED, 0, None, long_ago, None, None, None), *failed("a", long_ago), *failed("b", now), *failed("c", long_ago), (STORED, 0, 9, now, "c", "p", None)])
    go(spark, tmp_path, 1)
    tick(0)
    go(spark, tmp_path, 1)
    tick(1)
    got = [(x.id, x.action) for x in go(spark, tmp_path, 1).collect()]
    assert sorted(got) == [("a", "fetch"), ("a", "retry"), ("b", "fetch"), ("c", "fetch")]


def test_links_after_the_end(spark, tmp_path):
    for rows in ([(LISTED, 4, 0, START, "a", "p", "x"), (ENDED, 4, None, START, None, None, None), (STORED, 4, 0, START, "a", "p", None)], [(LISTED, 4, 1, START, "b", "q", "x"), (LISTED, 3, 1, START, "c", "q", "x")], [(LISTED, 4, 2, START, "b", "p", "y")], [(ENDED, 4, None, START, None, None, None), (ENDED, 3, None, START, None, None, None)]):
        add(spark, f"{tmp_path}/events", rows)
        got = go(spark, tmp_path, 2)
    assert sorted((x.id, x.action, x.partition) for x in got.collect()) == [("a", "fetch", "p"), ("b", "fetch", "q")]
    states = {x.id: (x.run, x.place, x.line) for x in file_states.states(spark, f"{tmp_path}/checkpoint").collect()}
    assert states == {"a": (4, "p", "x"), "b": (4, "p", "x"), "c": (3, "q", "x")}


def test_links_come_in_any_order():
    assert File().seen(1, 5, "b", "late").seen(1, 2, "c", "first").seen(0, 1, "a", "old") == File(1, 2, "b", "first")
    assert File(1, attempts=3, failed_at=0).settled(1, 1)[1] == ["skip"] and File(1, attempts=3, failed_at=0).settled(1, 86_400_000)[1] == ["fetch"]
    assert File(1).settled(2, 0) == (None, [])


class Store:
    """A processor's handle that counts what is asked of it."""

    def __init__(self):
        self.calls, self.timers, self.maps = Counter(), set(), {}

    def getMapState(self, name, *_):  # noqa: N802 - Spark's names
        return self.maps.setdefault(name, Values(self, name))

    getValueState = getMapState  # noqa: N815

    def registerTimer(self, at):  # noqa: N802
        self.calls["timer"] += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.discard(at)


class Values(dict):
    def __init__(self, store, name):
        self.store, self.name = store, name

    def iterator(self):
        self.store.calls[f"{self.name} read whole"] += 1
        return iter(list(self.items()))

    def getValue(self, key):  # noqa: N802
        self.store.calls[f"{self.name} read"] += 1
        return dict.get(self, key)

    def updateValue(self, key, value):  # noqa: N802
        self.store.calls[f"{self.name} written"] += 1
        self[key] = value

    def removeKey(self, key):  # noqa: N802
        self.pop(key, None)

    def get(self):
        return dict.get(self, None)

    def update(self, value):
        self[None] = value

    def clear(self):
        self.pop(None, None)


def test_a_batch_of_many_runs_reads_and_writes_a_file_once(monkeypatch):
    monkeypatch.setattr(file_states, "_FRAME", 30)
    store, runs, files = Store(), 12, 20
    states = file_states.FileStates()
    states.init(store)
    us = lambda r: round(time_of(r).timestamp() * 1_000_000)
    rows = [(LISTED, r, n, us(r), f"f{n}", "p", f"{r % 2}") for r in range(runs) for n in range(files)]
    rows += [(ENDED, r, -1, us(r), None, None, None) for r in range(runs)]
    rows += [(STORED, 0, n, us(0), f"f{n}", "p", None) for n in range(10)]
    rows += [(FAILED, 3, n * 3 + k, us(3) + n * 1000, f"f{n}", "p", None) for n in range(files) for k in range(3)]
    frame = lambda some: iter([pd.DataFrame(some, columns=file_states._COLUMNS)])
    told = pd.concat(states.handleInputRows((0,), frame(rows[::-1]), None))
    assert store.calls == {"files read whole": 1, "files written": files, "waits written": 10, "timer": 1}  # stored files wait for nothing
    assert Counter(told["action"]) == {"fetch": files + 10 * (runs - 2), "skip": 10, "update": 10 * (runs - 1)} and len(store.timers) == 1
    store.calls.clear()
    again = pd.concat(states.handleInputRows((0,), frame([(LISTED, runs - 1, 99, us(runs - 1), "f1", "p", "1")]), None))
    assert not len(again) and store.calls == {"files read": 1}  # without an end only what is named is read
    store.calls.clear()
    (until,) = store.timers
    retries = lambda now: pd.concat(states.handleExpiredTimer((0,), TimerValues(now), ExpiredTimerInfo(until)))["action"].tolist()
    middle = sorted(v[0] for v in store.maps["waits"].values())[4]
    want = sum(v[0] <= middle for v in store.maps["waits"].values())
    assert retries(middle) == ["retry"] * want and store.calls["waits read whole"] == 1 and max(store.timers) >= middle
    assert retries(until + 10_000) == ["retry"] * (10 - want) and not store.maps["waits"]
