"""State tables in versions, stored by buckets of a key, so that a version costs what it changes.

A row lies in the bucket that the hash of its key names, and each table's buckets are folders. A version is a
small file that names the folder of every bucket of every table; what a change does not touch it names again.
A new version becomes current by one rename, which fails if another writer has taken its number, and whoever
reads holds a snapshot: the tables of one version, whatever is written meanwhile. Files that no kept version
names are removed by ``vacuum``; a writer that fails leaves only such files.

Readers that know keys ask for their buckets and leave the others alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.files import SCHEMAS, conform

#: The column by which each table's rows are dealt to buckets; all tables of pages by the page's url.
KEYS = {
    "visited": "url", "queue": "url", "audios": "url", "retry_schedule": "url", "page_outcomes": "url",
    "audio_sizes": "audio_url", "downloads": "audio_url", "crawl_state": "key",
}
#: Buckets of a table where a state begins; the number stays with the state. About the size of the tables divided by that of a task's input.
BUCKETS = 64


class Taken(RuntimeError):
    """Another writer has made the next version."""


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Snapshot:
    """The tables of one version."""

    def __init__(self, spark: SparkSession, folder: str, manifest: dict):
        self.spark, self.folder, self.manifest = spark, folder, manifest

    @property
    def version(self) -> int:
        return self.manifest["version"]

    @property
    def buckets(self) -> int:
        return self.manifest["buckets"]

    def read(self, name: str, only: Iterable[int] | None = None) -> DataFrame:
        """A table, or its rows in some buckets; empty if nothing is there."""
        held = self.manifest["tables"].get(name, {})
        wanted = held.values() if only is None else [held[str(b)] for b in sorted(set(only)) if str(b) in held]
        paths = [f"{self.folder}/{p}" for p in wanted]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return conform(self.spark.read.option("mergeSchema", "true").parquet(*paths), SCHEMAS[name])

    def touched(self, keys: DataFrame) -> set[int]:
        """The buckets of keys (one column): as many numbers at most as there are buckets."""
        return {r[0] for r in keys.select(bucket_of(F.col(keys.columns[0]), self.buckets)).distinct().collect()}

    def top(self, name: str) -> int:
        """The largest id, for numbering on."""
        return self.read(name).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


class Versions:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        hadoop = spark._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _list(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._list(f"{self.folder}/versions") if n.endswith(".json"))

    def at(self, version: int) -> Snapshot:
        text = self.spark.read.text(f"{self.folder}/versions/{version}.json", wholetext=True).first()[0]
        return Snapshot(self.spark, self.folder, json.loads(text))

    def latest(self) -> Snapshot:
        """The current version; before the first one, empty tables."""
        numbers = self._numbers()
        return self.at(numbers[-1]) if numbers else Snapshot(self.spark, self.folder, {"version": 0, "buckets": self.buckets, "tables": {}})

    def commit(self, base: Snapshot, changes: dict[str, tuple[Iterable[int] | None, DataFrame]]) -> Snapshot:
        """The version after base: of each table of changes the given buckets (None: all) hold the given rows that belong to them; all else is as it was."""
        run = uuid.uuid4().hex
        tables = {name: dict(held) for name, held in base.manifest["tables"].items()}
        for name, (only, rows) in changes.items():
            only = set(range(base.buckets)) if only is None else set(only)
            if not only:
                continue
            at = f"data/{run}/{name}"
            rows = conform(rows, SCHEMAS[name]).withColumn("_bucket", bucket_of(F.col(KEYS[name]), base.buckets))
            if len(only) < base.buckets:
                rows = rows.where(F.col("_bucket").isin(sorted(only)))
            rows.repartition(min(len(only), int(self.spark.conf.get("spark.sql.shuffle.partitions"))), "_bucket").write.partitionBy("_bucket").parquet(f"{self.folder}/{at}")
            found = {n.partition("=")[2]: f"{at}/{n}" for n in self._list(f"{self.folder}/{at}") if n.startswith("_bucket=")}
            kept = {b: p for b, p in tables.get(name, {}).items() if int(b) not in only}
            tables[name] = kept | found
        return self._publish({"version": base.version + 1, "buckets": base.buckets, "tables": tables}, run)

    def _publish(self, manifest: dict, run: str) -> Snapshot:
        """One rename makes the version current."""
        draft, final = self._path(f"{self.folder}/drafts/{run}.json"), self._path(f"{self.folder}/versions/{manifest['version']}.json")
        self._fs.mkdirs(final.getParent())
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, final, options)
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                raise Taken(f"version {manifest['version']} of {self.folder} is there already") from e
            raise
        return Snapshot(self.spark, self.folder, manifest)

    def vacuum(self, keep: int = 2) -> int:
        """Removes all versions but the latest ones, and the files that these do not name; returns how many runs' folders went. Not while others write."""
        numbers = self._numbers()
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{self.folder}/versions/{n}.json"), False)
        named = {"/".join(p.split("/")[:-1]) for n in numbers[-keep:] for held in self.at(n).manifest["tables"].values() for p in held.values()}
        gone = 0
        for run in self._list(f"{self.folder}/data"):
            names = {name: f"data/{run}/{name}" for name in self._list(f"{self.folder}/data/{run}")}
            for path in names.values():
                if path not in named:
                    self._fs.delete(self._path(f"{self.folder}/{path}"), True)
            if not any(p in named for p in names.values()):
                self._fs.delete(self._path(f"{self.folder}/data/{run}"), True)
                gone += 1
        return gone

    def bytes_of(self, version: int) -> int:
        """Bytes of the files that the version names and the one before it does not: what it has written."""
        before = {p for held in self.at(version - 1).manifest["tables"].values() for p in held.values()} if version - 1 in self._numbers() else set()
        new = {p for held in self.at(version).manifest["tables"].values() for p in held.values()} - before
        return sum(self._fs.getContentSummary(self._path(f"{self.folder}/{p}")).getLength() for p in new)
