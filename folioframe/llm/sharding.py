"""A store of immutable shards with size-tiered compaction and versioned manifests.

An append writes the arrivals as they come, a file for each task, and commits. Compaction merges runs of similarly sized
shards: those below the target size are sorted into tiers by powers of ``fanout``, and a tier with ``fanout`` shards or
more is merged into files of about the target size. Each commit is a new manifest, written aside and renamed to
the next version's name, which fails if another writer took it; readers see whole versions only.

Native: rows are read and written by Spark without a shuffle (a merge reads whole shards into one task of about target
size); the driver handles names and sizes of files alone, through Hadoop's file systems.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

TARGET_BYTES, FANOUT, LEAST_BYTES = 128 << 20, 4, 1 << 20
#: Jobs that merge at once, and runs that one job merges, a task each.
PARALLEL, RUNS_A_JOB = 4, 64
#: Commits that a writer tries when others are first.
TRIES = 20


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class Shard:
    """One immutable Parquet file, its path relative to the store's root."""

    path: str
    bytes: int
    tier: int


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT, least_bytes: int = LEAST_BYTES):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.root = spark, root.rstrip("/")
        self.target_bytes, self.fanout, self.least_bytes = target_bytes, fanout, least_bytes
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _list(self, name: str) -> list[tuple[str, int]]:
        p = self._path(name)
        return [(f.getPath().getName(), f.getLen()) for f in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def tier_of(self, size: int) -> int:
        """0 below ``least_bytes`` * fanout, one more for each further factor of ``fanout``."""
        return max(0, int(math.log(max(size, 1) / self.least_bytes, self.fanout))) if size > self.least_bytes else 0

    def version(self) -> int:
        """The latest committed version; 0 before the first commit."""
        return max((int(n[1:-5]) for n, _ in self._list("manifests") if n.startswith("v") and n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "shards": []}
        lines = self.spark.read.text(f"{self.root}/manifests/v{version:012d}.json", wholetext=True).head()[0]
        m = json.loads(lines)
        return m | {"shards": [Shard(**s) for s in m["shards"]]}

    def _commit(self, base: dict, shards: list[Shard], schema: str | None) -> int:
        version = base["version"] + 1
        body = json.dumps({"version": version, "schema": schema, "shards": [asdict(s) for s in shards]})
        aside = self._path(f"manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(bytearray(body.encode()))
        out.close()
        name = self._path(f"manifests/v{version:012d}.json")
        # Rename fails where the name exists; the check before it only serves file systems that would overwrite.
        if self._fs.exists(name) or not self._fs.rename(aside, name):
            self._fs.delete(aside, False)
            raise CommitConflict(f"version {version} was committed by another writer")
        return version

    def _write(self, df: DataFrame) -> list[Shard]:
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        return [Shard(f"{folder}/{n}", size, self.tier_of(size)) for n, size in sorted(self._list(folder)) if n.endswith(".parquet")]

    def append(self, arrivals: DataFrame) -> int:
        """Write the rows of ``arrivals`` as new shards and commit; returns the version. Columns must be those of the store."""
        written = None
        for _ in range(TRIES):
            base = self.manifest()
            if base["schema"] and [(f.name, f.dataType) for f in arrivals.schema] != [(f.name, f.dataType) for f in self._schema(base)]:
                raise ValueError("the arrivals' columns are not those of the store")
            written = self._write(arrivals) if written is None else written
            try:
                return self._commit(base, base["shards"] + written, base["schema"] or arrivals.schema.json())
            except CommitConflict:  # the same shards are committed on top of what the other writer did
                continue
        raise CommitConflict(f"{TRIES} commits in a row lost against other writers")

    @staticmethod
    def _schema(manifest: dict):
        from pyspark.sql.types import StructType

        return StructType.fromJson(json.loads(manifest["schema"]))

    def runs(self, shards: list[Shard]) -> list[list[Shard]]:
        """Runs to merge now: of each tier with ``fanout`` shards below the target size, in groups of about that size."""
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if s.bytes < self.target_bytes / 2:
                tiers.setdefault(s.tier, []).append(s)
        found = []
        for _, members in sorted(tiers.items()):
            if len(members) < self.fanout:
                continue
            group: list[Shard] = []
            for s in sorted(members, key=lambda s: (s.bytes, s.path)):
                if group and sum(x.bytes for x in group) + s.bytes > self.target_bytes:
                    found.append(group)
                    group = []
                group.append(s)
            found.append(group)
        return [g for g in found if len(g) > 1]

    def compact(self) -> int:
        """Merge until no tier is full; one commit a round. Returns the version."""
        while True:
            base = self.manifest()
            runs = self.runs(base["shards"])
            if not runs:
                return base["version"]
            schema = self._schema(base)
            read = lambda run: self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.path}" for s in run]).coalesce(1)
            jobs = [runs[i : i + RUNS_A_JOB] for i in range(0, len(runs), RUNS_A_JOB)]
            with ThreadPoolExecutor(PARALLEL) as pool:
                merged = list(pool.map(lambda job: self._write(reduce(DataFrame.unionAll, map(read, job))), jobs))
            gone = {s.path for run in runs for s in run}
            for _ in range(TRIES):
                if not gone <= {s.path for s in base["shards"]}:  # another writer merged some of them; what was written here is never named
                    break
                try:
                    self._commit(base, [s for s in base["shards"] if s.path not in gone] + [s for m in merged for s in m], base["schema"])
                    break
                except CommitConflict:
                    base = self.manifest()
            else:
                raise CommitConflict(f"{TRIES} commits in a row lost against other writers")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError("nothing has been committed yet")
        schema = self._schema(m)
        paths = [f"{self.root}/{s.path}" for s in m["shards"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self, keep_versions: int = 10, older_than_s: float = 7 * 86400) -> int:
        """Delete shards that none of the latest ``keep_versions`` names and that are older than ``older_than_s``; returns how many went.

        The age protects shards that another writer has written and not yet committed. Versions before the kept ones can't
        be read afterwards.
        """
        latest = self.version()
        live = {s.path for v in range(max(1, latest - keep_versions + 1), latest + 1) for s in self.manifest(v)["shards"]}
        n, oldest = 0, (time.time() - older_than_s) * 1000
        for folder, _ in self._list("data"):
            for f in self._fs.listStatus(self._path(f"data/{folder}")):
                name = f"data/{folder}/{f.getPath().getName()}"
                if name.endswith(".parquet") and name not in live and f.getModificationTime() <= oldest:
                    self._fs.delete(f.getPath(), False)
                    n += 1
        return n


def ingest(tables: list[DataFrame], root: str, **options) -> ShardStore:
    """Append each table as an arrival and compact. Earlier versions stay readable until :meth:`ShardStore.vacuum`.

    All columns are kept as they are, null, long and repeated rows included; an empty table commits a version without rows.
    """
    store = ShardStore(tables[0].sparkSession, root, **options)
    for t in tables:
        store.append(t)
    store.compact()
    return store
