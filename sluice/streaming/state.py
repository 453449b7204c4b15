"""State of a consumer: targets, ledger, offsets and quarantine, committed together.

Parquet has neither ``MERGE`` nor a transaction over several tables, so a batch writes its
files into a new folder and then publishes one small version file naming every folder that
counts. Readers follow the newest version file; folders no version names are ignored. That
single rename is the commit.

    <path>/events/<id>/        the decoded events of one batch, each once
    <path>/ledger/<id>/        ledger rows of many batches, folded together now and then
    <path>/quarantine/<id>/    likewise
    <path>/frequent/<id>/      a summary of the hottest keys of folded events
    <path>/target/<T>/<id>/    base rows in buckets of keys, or folded changes
    <path>/_versions/<n>.json  the folders of version n, and one offset per broker partition

A batch is written once, by one job: the folder of its events is at the same time its ledger rows,
its rejects and the changes of every target; each reader opens only the columns it needs. A
second job over a few columns of what was written gives counts, ranges and offsets. Both grow
with the batch, never with the targets.

A version also says which sequences each ledger and quarantine folder holds per broker
partition, so a batch opens those folders only that can know its events. Where a folder holds a
run without gaps, the range itself is the answer and nothing is opened.

Targets are merged on read: readers lay the newest change per key over the base. When the
changes have grown to a share of the base they are merged into it. The base is bucketed by key, so
neither a reader nor a merge ever shuffles it; only the changes move. A merge rewrites the files of
the buckets that changed; when buckets outgrow ``bucket_bytes``, a merge rewrites them all into
twice as many (keys are unique, so buckets grow alike), each bucket in place, without a shuffle.
A version notes the highest key of every base file, so rows from a key on are read from few files.

Old versions and the folders and files that only they name are removed after a while.

Limits: one writer per path, and a file system with atomic rename (HDFS or a local disk; on
an object store use a table format with MERGE instead).
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from sluice import schemas as S
from sluice.operators import apply as A, frequent as K
from sluice.session import require_settings
from sluice.sources.changes import arrival_position

# Lowest and highest sequence, by broker partition.
Ranges = Mapping[int, tuple[int, int]]

_EMPTY = {"version": 0, "ledger": [], "quarantine": [], "offsets": {}, "targets": {}}
# Runs of known sequences a batch is compared with one by one; with more, folders are opened.
MOST_RUNS = 100


def _meets(folder: dict, ranges: Ranges) -> list[int] | None:
    """Broker partitions whose noted range meets the batch's; None if nothing is noted."""
    held = folder.get("ranges")
    if held is None:
        return None
    return [p for p, (lo, hi) in ranges.items() if str(p) in held and held[str(p)][0] <= hi and lo <= held[str(p)][1]]


def may_hold(folders: Sequence[dict], ranges: Ranges | None) -> list[dict]:
    """Folders that can hold an event of the ranges, by what is noted of them; no job."""
    if ranges is None:
        return list(folders)
    return [f for f in folders if (met := _meets(f, ranges)) is None or met]


def known_runs(folders: Sequence[dict], ranges: Ranges) -> tuple[list[tuple[int, int, int]], list[dict]]:
    """What the notes alone say of a batch: runs (partition, first, last) that are known without a gap,
    and the folders that must be opened for the rest."""
    runs, rest = set(), []
    for folder in folders:
        met = _meets(folder, ranges)
        dense = [p for p in met or [] if len(folder["ranges"][str(p)]) > 2 and _is_run(folder["ranges"][str(p)])]
        runs.update((p, *folder["ranges"][str(p)][:2]) for p in dense)
        if met is None or len(dense) < len(met):
            rest.append(folder)
    joined: list[tuple[int, int, int]] = []
    for p, first, last in sorted(runs):
        if joined and joined[-1][0] == p and first <= joined[-1][2] + 1:
            joined[-1] = (p, joined[-1][1], max(last, joined[-1][2]))
        else:
            joined.append((p, first, last))
    return (joined, rest) if len(joined) <= MOST_RUNS else ([], may_hold(folders, ranges))


def _is_run(held: Sequence[int]) -> bool:
    first, last, rows = held
    return rows == last - first + 1


def joined_ranges(folders: Sequence[dict]) -> Mapping[int, tuple[int, ...]] | None:
    """What several folders hold together: lowest, highest, rows; unknown if it is unknown of one."""
    out: dict[int, tuple[int, ...]] = {}
    for folder in folders:
        if "ranges" not in folder:
            return None
        for p, (lo, hi, *rows) in folder["ranges"].items():
            known = out.get(int(p), (lo, hi, 0))
            out[int(p)] = (min(known[0], lo), max(known[1], hi), *[known[2] + n for n in rows if len(known) > 2])
    return out


def _folders(manifest: dict) -> list[dict]:
    targets = [f for t in manifest["targets"].values() for f in (*t["base"], *t["changes"])]
    return [*manifest["ledger"], *manifest["quarantine"], *manifest.get("frequent", []), *targets]


def _keys_known(manifest: dict) -> bool:
    """Whether a summary of keys covers all folded events."""
    return "frequent" in manifest or all(f["path"].startswith("events/") for f in manifest["ledger"])


def files_from(base: dict, at_least: int | None) -> list[str] | None:
    """Base files that can hold keys from ``at_least`` on; None for all, also if no highest keys are noted."""
    if at_least is None or "highest" not in base:
        return None
    return [f for f in base["files"] if base["highest"].get(f, at_least) >= at_least]


def bucket_of(file: str) -> int:
    """The bucket a file belongs to, as Spark writes it into the name."""
    return int(re.search(r"_(\d+)(?:\.c\d+)?\.", file).group(1))


class _Files:
    """The few file operations needed, through Hadoop so that any shared folder works."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._streams = jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        where = self._path(folder)
        if not self._fs.exists(where):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(where)]

    def folders(self, folder: str) -> list[tuple[str, int]]:
        """Names and times of change, in milliseconds."""
        where = self._path(folder)
        if not self._fs.exists(where):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(where)]

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def sizes(self, folder: str) -> dict[str, int]:
        """Data files and their bytes."""
        found = ((s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self._path(folder)))
        return {name: size for name, size in found if not name.startswith(("_", "."))}

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._streams.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Make a new file appear with all its content; fail if it is there already."""
        draft, final = self._path(f"{path}.{uuid.uuid4().hex}.draft"), self._path(path)
        out = self._fs.create(draft, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"{path} was published by another writer")


@dataclass
class State:
    """A consumer's state under ``path``. Cheap to create; every read follows the newest version."""

    spark: SparkSession
    path: str
    specs: Sequence[S.TableSpec] = (S.ORDERS,)
    # Merge changes into the base once they reach this share of it (the first ones, of a bucket).
    merge_share: float = 0.5
    # Fold folders below this size together once there are this many.
    fold_count: int = 64
    fold_size: int = 1 << 30
    # Keys a summary of the hottest ones lists.
    hot_keys: int = K.CAPACITY
    # Buckets of a base at least; they double while one of them would hold more than ``bucket_bytes``.
    buckets: int = 16
    bucket_bytes: int = 256 << 20
    # Versions kept, and seconds that folders no version names are kept for readers and writers.
    keep_versions: int = 50
    keep_seconds: int = 6 * 3600
    _files: _Files = field(init=False, repr=False)

    def __post_init__(self) -> None:
        require_settings(self.spark)
        self._files = _Files(self.spark, self.path)

    # Versions

    def manifest(self, version: int | None = None) -> dict:
        if version is None:
            numbers = [
                int(n.removesuffix(".json"))
                for n in self._files.names(f"{self.path}/_versions")
                if n.endswith(".json")
            ]
            version = max(numbers, default=0)
        if version == 0:
            return json.loads(json.dumps(_EMPTY))
        return json.loads(self._files.read(f"{self.path}/_versions/{version}.json"))

    def publish(self, manifest: dict) -> dict:
        """Commit: from here on readers see the folders this manifest names."""
        manifest = {**manifest, "version": manifest["version"] + 1}
        self._files.publish(
            f"{self.path}/_versions/{manifest['version']}.json", json.dumps(manifest)
        )
        return manifest

    def reset(self) -> dict:
        """Empty everything; a following replay applies all events again."""
        return self.publish({**json.loads(json.dumps(_EMPTY)), "version": self.manifest()["version"]})

    # Reading

    def _read(self, schema: T.StructType, folders: Sequence[dict]) -> DataFrame:
        paths = [f"{self.path}/{f['path']}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def ledger_in(self, folders: Sequence[dict]) -> DataFrame:
        """Ledger rows of some folders."""
        return self.applied_in(folders).select(*S.LEDGER_SCHEMA.names)

    def applied_in(self, folders: Sequence[dict]) -> DataFrame:
        """Ledger rows of some folders with operation, table and key, which are NULL for folded ones."""
        more = [T.StructField("operation", T.StringType()), T.StructField("table", T.StringType()), T.StructField("key", T.LongType())]
        rows = self._read(T.StructType([*S.LEDGER_SCHEMA, *more, S.QUARANTINE_SCHEMA["reject_reason"]]), folders)
        return rows.filter(F.col("reject_reason").isNull()).drop("reject_reason")

    def ledger(self, manifest: dict | None = None, ranges: Ranges | None = None) -> DataFrame:
        """The ledger, or only its folders that can hold events of the given ranges."""
        return self.ledger_in(may_hold((manifest or self.manifest())["ledger"], ranges))

    def offsets(self, manifest: dict | None = None) -> DataFrame:
        rows = [(int(p), *offset) for p, offset in (manifest or self.manifest())["offsets"].items()]
        schema = T.StructType([*S.OFFSETS_SCHEMA.fields[:-1], T.StructField("updated_at", T.LongType())])
        updated = F.timestamp_micros("updated_at")
        return self.spark.createDataFrame(rows, schema).withColumn("updated_at", updated)

    def quarantine(self, manifest: dict | None = None, ranges: Ranges | None = None) -> DataFrame:
        folders = may_hold((manifest or self.manifest())["quarantine"], ranges)
        return self._read(S.QUARANTINE_SCHEMA, folders).filter(F.col("reject_reason").isNotNull())

    @contextmanager
    def _table(self, spec: S.TableSpec, base: dict) -> Iterator[str]:
        """A base as a bucketed table of the session's catalog, under a name used once.

        Only tables of the catalog know their buckets. A DataFrame made of the table keeps what it
        learned, so the name is taken back at once; the files stay where they are.
        """
        name = f"sluice_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{spec.key}`)"
            f" SORTED BY (`{spec.key}`) INTO {base['buckets']} BUCKETS LOCATION '{self.path}/{base['path']}'"
        )
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _base(self, spec: S.TableSpec, base: dict, only: Sequence[str] | None = None) -> DataFrame:
        """A target's base, or some of its files. Files are chosen while the folder is listed."""
        with self._table(spec, base) as name:
            rows = self.spark.table(name)
            if only is not None or base.get("replaced"):
                rows = rows.filter(F.col("_metadata.file_name").isin(list(base["files"] if only is None else only)))
            return rows.select(spec.key, *spec.column_names)

    def _changes_schema(self, spec: S.TableSpec) -> T.StructType:
        row = T.StructType([T.StructField(c.name, c.data_type) for c in spec.columns])
        return T.StructType([
            *S.LEDGER_SCHEMA.fields[:2], S.LEDGER_SCHEMA["arrival"], T.StructField("operation", T.StringType()),
            T.StructField("table", T.StringType()), T.StructField("key", T.LongType()), T.StructField(spec.name, row),
            S.QUARANTINE_SCHEMA["reject_reason"], T.StructField("changed_in", T.LongType()),
        ])

    def _newest(self, spec: S.TableSpec, folders: Sequence[dict]) -> DataFrame:
        """The newest change per key: of the latest batch, the one that arrived last."""
        mine = A.only_table(self._read(self._changes_schema(spec), folders), spec.name).filter(F.col("reject_reason").isNull())
        order = [F.col(c).desc() for c in ("changed_in", "arrival", *S.EVENT_ID)]
        newest = Window.partitionBy("key").orderBy(*order)
        return A.changes_rows(mine).withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")

    def _net(self, spec: S.TableSpec, folders: Sequence[dict]) -> DataFrame:
        return self._newest(spec, folders).select(
            F.col("key").cast(spec.key_kind).alias(spec.key), f"{spec.name}.*", "operation"
        )

    def target(self, spec: S.TableSpec, manifest: dict | None = None, at_least: int | None = None) -> DataFrame:
        """Current rows of a target: its base with the unmerged changes laid over.

        The base is never shuffled: small changes are broadcast (Spark's choice, by their file
        size), larger ones are dealt out to the base's buckets. ``at_least`` gives the rows from a key
        on; base files whose noted highest key lies below it are not opened.
        """
        known = (manifest or self.manifest())["targets"].get(spec.name, {"base": [], "changes": []})
        wanted = F.lit(True) if at_least is None else F.col(spec.key) >= at_least
        net = self._net(spec, known["changes"]).filter(wanted)
        if not known["base"]:
            return A.rows_from(net, spec)
        [base] = known["base"]
        rows = self._base(spec, base, files_from(base, at_least)).filter(wanted)
        if not known["changes"]:
            return rows
        return A.merge_changes(rows, net.repartition(base["buckets"], spec.key), spec)

    def deleted(self, spec: S.TableSpec, manifest: dict, at_least: int) -> int:
        """Keys from ``at_least`` on that the unmerged changes delete, whether or not the base holds them."""
        changes = manifest["targets"][spec.name]["changes"]
        net = self._net(spec, changes).filter((F.col(spec.key) >= at_least) & (F.col("operation") == S.DELETE))
        return net.count() if changes else 0

    def frequent_keys(self, manifest: dict | None = None) -> DataFrame:
        """The hottest keys of all applied events, each with the least and the most events it can have.

        From the summary kept of folded events, and from the events that are not folded yet.
        """
        manifest = manifest or self.manifest()
        if not _keys_known(manifest):
            raise ValueError("events were folded before a summary of their keys was kept")
        return K.frequent_keys(self._key_summary(manifest, manifest["ledger"]), ["table", "key"])

    def _key_summary(self, manifest: dict, folders: Sequence[dict]) -> DataFrame:
        """The stored summary and that of the event folders among some, merged."""
        keys, events = ["table", "key"], [f for f in folders if f["path"].startswith("events/")]
        stored = manifest.get("frequent", [])
        by_key = T.StructType([
            T.StructField("table", T.StringType()), T.StructField("key", T.LongType()), S.QUARANTINE_SCHEMA["reject_reason"],
        ])
        applied = self._read(by_key, events).filter(F.col("reject_reason").isNull())
        fresh = K.key_summary(applied, keys, self.hot_keys)
        if not stored:
            return fresh
        kept = self._read(fresh.schema, stored)
        return K.merged_summaries([kept, fresh], keys, self.hot_keys)

    # Writing

    def write(self, df: DataFrame, folder: str) -> dict:
        """Write a folder that counts only once a published manifest names it."""
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{path}")
        return {"path": path, "size": sum(self._files.sizes(f"{self.path}/{path}").values())}

    def write_events(self, events: DataFrame, manifest: dict) -> tuple[dict, DataFrame]:
        """Write a batch's events, each once; gives the folder and its rows."""
        now, rejected = F.current_timestamp(), F.col("reject_reason").isNotNull()
        rows = events.select(
            *S.EVENT_ID, arrival_position(events).alias("arrival"), "operation", "table", "key", "commit_lsn",
            *[s.name for s in self.specs], "reject_reason", "value", now.alias("processed_at"),
            F.when(rejected, now).alias("rejected_at"), F.lit(manifest["version"] + 1).cast("long").alias("changed_in"),
        )
        folder = self.write(rows, "events")
        return folder, self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder['path']}")

    def discard(self, folder: dict) -> None:
        """Remove a folder that was never published."""
        self._files.delete(f"{self.path}/{folder['path']}")

    def _write_base(self, rows: DataFrame, spec: S.TableSpec, buckets: int) -> dict:
        """Write rows bucketed by key; rows that come bucketed already are not shuffled."""
        path, name = f"target/{spec.name}/{uuid.uuid4().hex}", f"sluice_{uuid.uuid4().hex}"
        (
            rows.select(spec.key, *spec.column_names)
            .write.bucketBy(buckets, spec.key).sortBy(spec.key).format("parquet")
            .option("path", f"{self.path}/{path}").saveAsTable(name)
        )
        self.spark.sql(f"DROP TABLE {name}")
        files = self._files.sizes(f"{self.path}/{path}")
        highest = self._highest(spec, path)
        return {"path": path, "buckets": buckets, "files": files, "highest": highest, "size": sum(files.values())}

    def _highest(self, spec: S.TableSpec, path: str, only: Sequence[str] | None = None) -> dict[str, int]:
        """The highest key per file of a base folder, or of some of its files; reads that column only."""
        rows, file = self.spark.read.schema(spec.schema).parquet(f"{self.path}/{path}"), F.col("_metadata.file_name")
        if only is not None:
            rows = rows.filter(file.isin(list(only)))
        return {r["file"]: r["key"] for r in rows.groupBy(file.alias("file")).agg(F.max(spec.key).alias("key")).collect()}

    def maintain(self) -> None:
        """Merge and fold what has grown too fragmented; changes no visible row."""
        manifest = self.manifest()
        before = json.dumps(manifest)
        for spec in self.specs:
            known = manifest["targets"].get(spec.name)
            if not known or not known["changes"]:
                continue
            changed = sum(f["size"] * f.get("share", {}).get(spec.name, 1) for f in known["changes"])
            if changed > self.merge_share * (sum(f["size"] for f in known["base"]) or self.bucket_bytes):
                manifest["targets"][spec.name] = {"base": [self._merged(spec, known, changed)], "changes": []}
            elif len(known["changes"]) > self.fold_count:
                folded = self.write(self._newest(spec, known["changes"]), f"target/{spec.name}")
                manifest["targets"][spec.name] = {**known, "changes": [folded]}
        for name, read in (("ledger", self.ledger_in), ("quarantine", lambda folders: self.quarantine({"quarantine": folders}))):
            # Folders of events shrink to what is needed of them, whatever their size.
            small = [f for f in manifest[name] if f["size"] < self.fold_size or f["path"].startswith("events/")]
            if len(small) > self.fold_count:
                if name == "ledger" and _keys_known(manifest):
                    manifest["frequent"] = [self.write(self._key_summary(manifest, small), "frequent")]
                # By range, so that file statistics skip what lies before a batch's sequences.
                rows = read(small).repartitionByRange(*S.EVENT_ID).sortWithinPartitions(*S.EVENT_ID)
                folded, held = self.write(rows, name), joined_ranges(small)
                folded |= {} if held is None else {"ranges": {str(p): list(r) for p, r in held.items()}}
                if all("arrivals" in f for f in small):
                    folded["arrivals"] = [min(f["arrivals"][0] for f in small), max(f["arrivals"][1] for f in small)]
                manifest[name] = [*[f for f in manifest[name] if f not in small], folded]
        if json.dumps(manifest) != before:
            manifest = self.publish(manifest)
        self._expire(manifest["version"])

    def _merged(self, spec: S.TableSpec, known: dict, changed: float) -> dict:
        """The base with all changes; only the changes move, and only buckets they touch are rewritten."""
        size = changed + sum(f["size"] for f in known["base"])
        buckets = known["base"][0]["buckets"] if known["base"] else self.buckets
        while size > buckets * self.bucket_bytes:
            buckets *= 2
        net = self._net(spec, known["changes"])
        if not known["base"]:
            return self._write_base(A.rows_from(net, spec).repartition(buckets, spec.key), spec, buckets)
        [base] = known["base"]
        dealt = net.repartition(base["buckets"], spec.key).hint("merge")
        if buckets == base["buckets"]:
            bucket = F.pmod(F.hash(spec.key), F.lit(buckets)).alias("bucket")
            touched = {r["bucket"] for r in net.select(bucket).distinct().collect()}  # as many as buckets, at most
            if 2 * len(touched) <= buckets:
                return self._rewritten(spec, base, dealt, touched)
        return self._write_base(A.merge_changes(self._base(spec, base), dealt, spec), spec, buckets)

    def _rewritten(self, spec: S.TableSpec, base: dict, net: DataFrame, touched: set[int]) -> dict:
        """The base with the files of some buckets replaced by new ones in the same folder."""
        folder = f"{self.path}/{base['path']}"
        old = [f for f in base["files"] if bucket_of(f) in touched]
        there = self._files.sizes(folder)
        rows = A.merge_changes(self._base(spec, base, old), net, spec)
        with self._table(spec, base) as name:
            rows.select(*spec.schema.names).write.insertInto(name)
        new = {f: n for f, n in self._files.sizes(folder).items() if f not in there}
        files = {f: n for f, n in base["files"].items() if f not in old} | new
        changed = {**base, "files": files, "size": sum(files.values()), "replaced": True}
        if "highest" in base:
            highest = base["highest"] | (self._highest(spec, base["path"], list(new)) if new else {})
            changed["highest"] = {f: k for f, k in highest.items() if f in files}
        return changed

    def _expire(self, newest: int) -> None:
        """Remove old versions, and folders and files that no kept version names and no writer may still fill."""
        versions = sorted(
            int(n.removesuffix(".json")) for n, _ in self._files.folders(f"{self.path}/_versions") if n.endswith(".json")
        )
        old = [v for v in versions if v <= newest - self.keep_versions]
        if not old:
            return
        kept = [f for v in versions if v not in old for f in _folders(self.manifest(v))]
        named: dict[str, set[str]] = {}
        for folder in kept:
            named.setdefault(folder["path"], set()).update(folder.get("files", ()))
        limit = time.time() * 1000 - self.keep_seconds * 1000
        for part in ["events", "ledger", "quarantine", "frequent", *[f"target/{s.name}" for s in self.specs]]:
            for name, changed in self._files.folders(f"{self.path}/{part}"):
                path = f"{part}/{name}"
                if path not in named and changed < limit:
                    self._files.delete(f"{self.path}/{path}")
                elif named.get(path):
                    for file, written in self._files.folders(f"{self.path}/{path}"):
                        if file not in named[path] and not file.startswith(("_", ".")) and written < limit:
                            self._files.delete(f"{self.path}/{path}/{file}")
        for v in old:
            self._files.delete(f"{self.path}/_versions/{v}.json")
