"""Tables whose versions are switched together by one manifest (K6, K7, K8).

A table is a set of folders ``<table>/v=<n>[/day=<day>]``. Which of them count is
written in ``_manifests/<n>.json``, one small file a version, put in place by a rename.
Readers take the newest manifest: they see all tables as of one version, never a
table half written or none at all. Folders that a version replaces stay for ``KEEP`` more
versions, for readers still on them, and are then removed.

A version is made from the one before and is known by its number, so a writer that died
is simply repeated: its folders are overwritten, and without a manifest they count for
nothing.

Partitions take additions in one of two ways. ``add`` writes the changed keys' amounts as
a folder of their own and merges them with the partition's other folders once there are
``MERGE``, so a read, and a batch, meets at most ``MERGE`` folders of a partition however
many batches there have been, and a key is rewritten once in ``MERGE`` batches at most.
``replace`` puts a new folder in the partition's place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP, MERGE = 10, 8
DAY = "day"


@dataclass
class Manifest:
    """Version ``batch``: the live folders of each table, and the writer's own ``state``."""

    batch: int = -1
    state: dict = field(default_factory=dict)
    tables: dict[str, dict[str, list[int]]] = field(default_factory=dict)
    dropped: dict[str, list[str]] = field(default_factory=dict)  # version -> folders it replaced

    def folders(self, table: str, parts: list[str] | None = None) -> list[str]:
        live = self.tables.get(table, {})
        wanted = live if parts is None else [p for p in parts if p in live]
        return [f"{table}/v={v}" + (f"/{DAY}={p}" if p else "") for p in wanted for v in live[p]]


class Versions:
    """Versioned tables below ``root``, on any file system Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.root}/{p}")
        self._fs = self._path("x").getFileSystem(spark._jsc.hadoopConfiguration())

    # -------------------------------------------------------------- manifests

    def _numbers(self) -> list[int]:
        folder = self._path("_manifests")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def head(self) -> Manifest:
        """The newest version, or an empty one where nothing was committed."""
        numbers = self._numbers()
        if not numbers:
            return Manifest()
        stream = self._fs.open(self._path(f"_manifests/{numbers[-1]}.json"))
        try:
            return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def next(self) -> Manifest:
        """A draft of the version after the newest one, equal to it so far."""
        head = self.head()
        return Manifest(head.batch + 1, dict(head.state), {t: {p: list(v) for p, v in ps.items()} for t, ps in head.tables.items()},
                        {v: list(f) for v, f in head.dropped.items()})

    def commit(self, draft: Manifest) -> None:
        """Make ``draft`` the newest version, then remove what no kept version names."""
        old = [v for v in draft.dropped if int(v) <= draft.batch - KEEP]
        gone = [f for v in old for f in draft.dropped.pop(v)]
        made = self._path(f"_manifests/_{draft.batch}.tmp")
        stream = self._fs.create(made, True)
        stream.write(bytearray(json.dumps(vars(draft)).encode()))
        stream.close()
        final = self._path(f"_manifests/{draft.batch}.json")
        if not self._fs.rename(made, final):
            raise OSError(f"version {draft.batch} of {self.root} could not be committed")
        for f in gone:
            self._fs.delete(self._path(f), True)
        for n in self._numbers():
            if n <= draft.batch - KEEP:
                self._fs.delete(self._path(f"_manifests/{n}.json"), False)

    # -------------------------------------------------------------- tables

    def read(self, table: str, schema: str, manifest: Manifest | None = None, parts: list[str] | None = None) -> DataFrame:
        """The live rows of ``table`` (of some of its days)."""
        folders = (manifest or self.head()).folders(table, parts)
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}") \
            .parquet(*[f"{self.root}/{f}" for f in folders])
        return rows.drop("v")

    def _write(self, df: DataFrame, table: str, batch: int, by_day: bool) -> None:
        w = df.write.mode("overwrite")
        (w.partitionBy(DAY) if by_day else w).parquet(f"{self.root}/{table}/v={batch}")

    def _place(self, draft: Manifest, table: str, part: str, fresh: bool) -> None:
        live = draft.tables.setdefault(table, {})
        if fresh:
            draft.dropped.setdefault(str(draft.batch), []).extend(draft.folders(table, [part]))
            live[part] = []
        live.setdefault(part, []).append(draft.batch)

    def add(self, draft: Manifest, table: str, schema: str, changes: DataFrame, keys: list[str], value: str,
            days: list[str], how=F.sum) -> None:
        """Add ``changes`` (one row a key) to the partitions ``days`` of a table whose value is
        the ``how`` (sum, min) over its folders."""
        live = draft.tables.get(table, {})
        full = [d for d in days if len(live.get(d, [])) + 1 >= MERGE]
        rows = changes.select(*keys, value)
        if full:
            rows = rows.unionByName(self.read(table, schema, draft, full).select(*keys, value)) \
                .groupBy(*keys).agg(how(value).alias(value))
        self._write(rows, table, draft.batch, days != [""])
        for d in days:
            self._place(draft, table, d, d in full)

    def replace(self, draft: Manifest, table: str, rows: DataFrame, days: list[str]) -> None:
        """Put ``rows`` in the place of the partitions ``days`` ([""]: of the whole table)."""
        self._write(rows, table, draft.batch, days != [""])
        for d in days:
            self._place(draft, table, d, True)

    def log(self, draft: Manifest, table: str, rows: DataFrame, by: str | None = None) -> None:
        """``rows`` as the part of a log that version ``draft`` adds; logs need no manifest entry."""
        w = rows.write.mode("overwrite")
        (w.partitionBy(by) if by else w).parquet(f"{self.root}/{table}/v={draft.batch}")

    def read_log(self, table: str, schema: str, versions: list[int] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """All rows of a log up to the newest version, or what some versions added."""
        newest = (manifest or self.head()).batch
        if newest < 0 or versions == [] or not self._fs.exists(self._path(table)):
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{table}"] if versions is None else [f"{self.root}/{table}/v={v}" for v in versions]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return rows.filter(F.col("v") <= newest).drop("v")
