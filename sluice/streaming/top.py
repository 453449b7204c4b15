"""The newest of a committed state: rows with the highest keys, and events applied last, out of few files.

The notes of a version give a bound below which nothing can be among the first n, before any data
is read. Of a base, every file's highest key is a row of its own, so the n-th highest of them is such
a bound, and exactly n files reach it. Of the ledger, folders are taken by their first arrival,
latest first, until they hold n events; the last one's first arrival is the bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sluice import schemas as S
from sluice.operators import views as V
from sluice.streaming.state import State


def key_bound(state: State, spec: S.TableSpec, n: int, manifest: dict) -> int | None:
    """A key from which on the target has at least n rows; None if the notes give none.

    Unmerged deletions may take rows of the base, so as many more files are taken as they can empty. Each step
    at least doubles the files, and counts deletions in the unmerged changes only.
    """
    known = manifest["targets"].get(spec.name)
    if not known or not known["base"] or "highest" not in known["base"][0]:
        return None
    highest, files = sorted(known["base"][0]["highest"].values(), reverse=True), max(n, 1)
    while files <= len(highest):
        bound = highest[files - 1]
        gone = state.deleted(spec, manifest, bound)
        if files - gone >= n:
            return bound
        files = max(2 * files, n + gone)
    return None


def top_rows(state: State, spec: S.TableSpec, n: int, manifest: dict | None = None) -> DataFrame:
    """The n rows of a target with the highest keys, highest first."""
    manifest = manifest or state.manifest()
    rows = state.target(spec, manifest, key_bound(state, spec, n, manifest))
    return rows.orderBy(F.col(spec.key).desc()).limit(n)


def arrival_bound(folders: Sequence[dict], n: int) -> int | None:
    """An arrival from which on the folders hold at least n events; None if their notes give none. No job."""
    held = 0
    for folder in sorted((f for f in folders if "arrivals" in f), key=lambda f: f["arrivals"][0], reverse=True):
        held += sum(rows for _, _, *noted in folder["ranges"].values() for rows in noted)
        if held >= n:
            return folder["arrivals"][0]
    return None


def may_reach(folders: Sequence[dict], bound: int | None) -> list[dict]:
    """Folders that can hold an event that arrived at the bound or later."""
    return [f for f in folders if bound is None or "arrivals" not in f or f["arrivals"][1] >= bound]


def recent_events(state: State, n: int = 200, manifest: dict | None = None) -> DataFrame:
    """The n events applied last, newest arrival first; of folded events neither operation nor key is kept."""
    folders = (manifest or state.manifest())["ledger"]
    bound = arrival_bound(folders, n)
    rows = state.applied_in(may_reach(folders, bound))
    if bound is not None:
        rows = rows.filter(F.col("arrival") >= bound)
    newest = [F.col(c).desc() for c in ("arrival", *S.EVENT_ID)]
    return rows.orderBy(*newest).limit(n).select(
        "arrival", "partition_id", "sequence_number", F.coalesce("operation", F.lit(V.FROM_STATE)).alias("op"),
        V.key_text(state.specs, F.col("table"), F.col("key")).alias("key_text"), "commit_lsn",
    )
