"""A set of tables that change together: a commit shows in all of them or in none.

Tables lie in parts by a hash of their keys. A commit writes the parts that it touches to a folder of its own and
then puts a manifest in place, which lists the folder of every part of every table. Readers go by the latest manifest, so a
writer that is lost on the way leaves nothing but files that no manifest lists. What must hold for the rows is
observed while they are written; if it doesn't, no manifest follows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Someone else committed since the version that a commit was based on."""


class Snapshots:
    """The tables below ``root``; ``keys`` has the keys of each. A table has ``buckets`` parts, so a manifest is small."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, list[str]], buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the manifests that are there."""
        at = self._path(f"{self.root}/manifests")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, the latest if not given; version 0 has no tables."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else 0)
        if version == 0:
            return {"version": 0, "tables": {}, "streams": {}}
        if version not in known:
            raise ValueError(f"no version {version} in {self.root}")
        return json.loads(self.spark.read.text(f"{self.root}/manifests/{version}.json", wholetext=True).head()[0])

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        """A table as of a version; None if it has no rows yet."""
        return self._rows(self.manifest(version), table)

    def _rows(self, manifest: dict, table: str, parts: list[int] | None = None) -> DataFrame | None:
        known = manifest["tables"].get(table)
        if known is None:
            return None
        paths = sorted(f"{self.root}/data/{d}/{table}/_part={b}" for b, d in known["parts"].items() if parts is None or int(b) in parts)
        schema = StructType.fromJson(known["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, changes: dict[str, DataFrame], base: int | None = None, stream: tuple[str, int] | None = None, error: str | None = None) -> int:
        """Upserts rows into several tables at once and gives the new version.

        Columns that ``changes`` supplies are replaced in matching rows, also by null; others are kept, and new columns
        are added. Rows must have whole keys, one row a key, and a null in the column ``error`` where a table has it; else a
        ValueError tells how many don't, and nothing changes. ``base`` is the version that the changes were made for: if
        another is the latest by then, Conflict is raised and nothing changes. ``stream`` (name, batch) makes a batch that
        was committed before do nothing. A table takes a job over its keys, which finds the parts, and one
        that writes them and counts the rows on the way.
        """
        now = self.manifest()
        if base is not None and base != now["version"]:
            raise Conflict(f"version {now['version']} came after {base}")
        if stream and now["streams"].get(stream[0], -1) >= stream[1]:
            return now["version"]
        folder = uuid.uuid4().hex
        tables = dict(now["tables"])
        for table, rows in changes.items():
            tables[table] = self._staged(now, table, rows, folder, error)
        streams = now["streams"] | ({stream[0]: stream[1]} if stream else {})
        self._publish({"version": now["version"] + 1, "tables": tables, "streams": streams}, folder)
        return now["version"] + 1

    def _staged(self, now: dict, table: str, rows: DataFrame, folder: str, error: str | None) -> dict:
        keys = self.keys[table]
        supplied = [c for c in rows.columns if c not in keys and c != error]
        part = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        bad = F.col(error).isNotNull() if error in rows.columns else F.lit(False)
        one = rows.groupBy(*keys).agg(F.first(F.struct(F.lit(True).alias("new"), *supplied)).alias("x"), F.count("*").alias("times"), F.count_if(bad).alias("errors"))
        seen = Observation()
        one = one.observe(seen, F.count_if(F.col("times") > 1).alias("repeated"), F.count_if(~whole).alias("without a key"), F.sum("errors").alias("with an error"))
        parts = [int(r[0]) for r in rows.select(part).distinct().collect()]
        if not parts:
            return now["tables"].get(table) or {"schema": json.loads(rows.drop(error or "").schema.json()), "parts": {}}
        old = self._rows(now, table, parts)
        if old is None:
            old = self.spark.createDataFrame([], rows.select(*keys).schema)
        j = old.alias("s").join(one.alias("n"), keys, "full")
        take = lambda c: F.when(F.col("n.x.new"), F.col(f"n.x.{c}")).otherwise(F.col(f"s.{c}")) if c in old.columns else F.col(f"n.x.{c}")
        out = j.select(*keys, *[(take(c) if c in supplied else F.col(f"s.{c}")).alias(c) for c in dict.fromkeys([*old.columns, *supplied]) if c not in keys])
        # one file a part; a part has a share of the keys, not one key
        out.withColumn("_part", part).repartition(max(1, len(parts)), "_part").write.partitionBy("_part").parquet(f"{self.root}/data/{folder}/{table}")
        wrong = {k: n for k, n in seen.get.items() if n}
        if wrong:
            raise ValueError(f"{table}: rows {', '.join(f'{k}: {n}' for k, n in wrong.items())}; nothing is applied")
        # parts written before lack columns that came later; the schema makes them null
        known = now["tables"].get(table, {"parts": {}})
        return {"schema": json.loads(out.schema.json()), "parts": known["parts"] | {str(b): folder for b in parts}}

    def _publish(self, manifest: dict, folder: str) -> None:
        target, text = self._path(f"{self.root}/manifests/{manifest['version']}.json"), json.dumps(manifest)
        draft = self._path(f"{self.root}/manifests/.{folder}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        # a rename shows the whole manifest or none; where the name is taken another writer was first
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise Conflict(f"version {manifest['version']} was committed meanwhile")

    def expire(self, keep: int = 2) -> int:
        """Removes all but the last ``keep`` versions, and data that none of those lists; gives the number of folders removed.

        Not for use beside a running commit, whose folder isn't listed yet.
        """
        known = self.versions()
        kept = known[-keep:]
        used = {d for v in kept for t in self.manifest(v)["tables"].values() for d in t["parts"].values()}
        for v in known[: len(known) - len(kept)]:
            self._fs.delete(self._path(f"{self.root}/manifests/{v}.json"), False)
        at, gone = self._path(f"{self.root}/data"), 0
        for f in self._fs.listStatus(at) if self._fs.exists(at) else []:
            if f.getPath().getName() not in used:
                gone += bool(self._fs.delete(f.getPath(), True))
        return gone

    def compact(self) -> int:
        """Rewrites all tables from the latest version into one folder, with as many files as parts, and gives the new version."""
        now = self.manifest()
        folder = uuid.uuid4().hex
        tables = {}
        for table, known in now["tables"].items():
            part = F.pmod(F.xxhash64(*self.keys[table]), F.lit(self.buckets)).cast("int")
            parts = sorted(map(int, known["parts"]))
            if parts:
                self._rows(now, table).withColumn("_part", part).repartition(len(parts), "_part").write.partitionBy("_part").parquet(f"{self.root}/data/{folder}/{table}")
            tables[table] = known | {"parts": {str(b): folder for b in parts}}
        self._publish(now | {"version": now["version"] + 1, "tables": tables}, folder)
        return now["version"] + 1
