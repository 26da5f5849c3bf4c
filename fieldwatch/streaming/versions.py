"""Keyed state of a streaming job as a table of versions.

Batch n writes version n: the rows of the keys that changed, as a delta. Every
``every`` batches the deltas are merged into a full version. Reading version n merges
the newest full version up to n with the deltas after it, the latest row of each key
winning. What a batch writes follows the keys it touches, not all keys ever seen.

Batch n reads version n - 1 and rewrites version n when it is replayed, so replays are
idempotent. Every batch writes its delta, empty or not: a version that cannot be read
whole is an error, never a fresh start. Versions that no replay needs are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldwatch.sinks import storage

_V = "_version"


class KeyedVersions:
    def __init__(self, spark: SparkSession, folder: str, key: str | list[str], schema: str,
                 every: int = 10):
        self.spark, self.folder, self.key, self.every = spark, folder.rstrip("/"), key, every
        self.schema = StructType.fromDDL(schema)

    def _path(self, kind: str, version: int) -> str:
        return f"{self.folder}/{kind}/v={int(version)}"

    def _versions(self, kind: str) -> list[int]:
        return [int(name[2:]) for _, name, _ in storage.children(self.spark, f"{self.folder}/{kind}")
                if name.startswith("v=")]

    def read(self, version: int) -> DataFrame:
        """All keys as of ``version`` (none before the first)."""
        return self._merged(version, version)

    def _merged(self, version: int, newest_full: int) -> DataFrame:
        if version < 0:
            return self.spark.createDataFrame([], self.schema)
        base = max((v for v in self._versions("full") if v <= newest_full), default=-1)
        read = lambda kind, v: (self.spark.read.schema(self.schema).parquet(self._path(kind, v))
                                .withColumn(_V, F.lit(v)))
        parts = ([read("full", base)] if base >= 0 else []) + [read("delta", v) for v in range(base + 1, version + 1)]
        if len(parts) == 1:
            return parts[0].drop(_V)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        names = self.schema.fieldNames()
        return (out.groupBy(self.key).agg(F.max_by(F.struct(*names), _V).alias("s"))
                .select(*[F.col(f"s.{n}").alias(n) for n in names]))

    def write(self, version: int, changes: DataFrame, keep: Column | None = None) -> None:
        """Version ``version``: the rows of ``changes`` (one a key) on top of the one before.
        ``keep`` tells which rows of a full version are still of use; the others end
        with the next merge."""
        (changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
         .write.mode("overwrite").parquet(self._path("delta", version)))
        if (version + 1) % self.every == 0:
            merged = self._merged(version, version - 1)
            if keep is not None:
                merged = merged.where(keep)
            merged.write.mode("overwrite").parquet(self._path("full", version))

    def remove_before(self, version: int) -> None:
        """Remove what reading ``version`` and later ones does not need."""
        base = max((v for v in self._versions("full") if v <= version), default=-1)
        for v in self._versions("full"):
            if v < base:
                storage.delete(self.spark, self._path("full", v))
        for v in self._versions("delta"):
            if v <= base:
                storage.delete(self.spark, self._path("delta", v))
