"""One budget for many collections, and commits inside a run.

Collections take turns in an order that starts with those that wait the longest.  A turn may last until the end of the budget less a
reserve for each collection that is still to come, so the first may use what is left over, and what a turn doesn't use goes on to
the next.  Where the budget is smaller than all reserves, each gets an equal share of it.

A collection's run commits every so many seconds of asking and plans again on what it committed: files that this run has asked for
already, whether they came, were the same or failed, aren't asked for again, so a run in slices asks what a run in one piece does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import replace

from pyspark.sql import DataFrame

from parchment.plans.runner import CHECKPOINT, Run, sync
from parchment.plans.store import SnapshotStore
from parchment.plans.sync import Options
from parchment.sources.http import Fetcher

#: Counts that say how much there is, and not how much was done.
_LEVELS = ("partitions",)


def waiting_order(manifests: dict[str, dict]) -> list[str]:
    """Collections that never had a whole run, then those whose run was stopped, then by the day of their last whole run; equals as given."""

    def rank(name: str) -> tuple:
        listing, runs = manifests[name].get("listing"), manifests[name].get("runs") or [{}]
        return (0, "") if not listing else (1, listing["at"]) if runs[-1].get("stopped") else (2, listing["at"])

    return sorted(manifests, key=rank)


def turns(names: Iterable[str], total: float, reserve: float, clock: Callable[[], float]) -> Iterator[tuple[str, float]]:
    """(collection, deadline) one after another; a collection whose turn comes after the end isn't named."""
    left, end = list(names), clock() + total
    reserve = min(reserve, total / len(left)) if left else reserve
    while left and clock() < end:
        name = left.pop(0)
        yield name, max(end - reserve * len(left), min(clock() + reserve, end))


def sync_in_slices(store: SnapshotStore, units: DataFrame, client: Fetcher, run: Run, options: Options, every: float, **more) -> dict:
    """sync() with a commit after every so many seconds of asking; run gets the counts of all slices, and why it stopped."""
    run.counts = {}
    left = run.max_files
    while True:
        part = replace(run, commit_every=every, counts={}, stopped=None, max_files=left)
        manifest = sync(store, units, client, part, options, **more)
        for k, n in part.counts.items():
            run.counts[k] = max(run.counts.get(k, 0), n) if k in _LEVELS else run.counts.get(k, 0) + n
        run.slices += 1
        if left is not None:
            left = max(left - sum(part.counts[k] for k in ("added", "replaced", "unchanged", "failed")), 0)
        if part.stopped != CHECKPOINT or left == 0:
            run.stopped = None if part.stopped == CHECKPOINT else part.stopped
            return manifest
