"""Tables that micro-batches merge into: buckets of rows by key, of which a batch rewrites those that it touches.

A batch reads the buckets of its keys as the batch before left them, merges, and writes them as a new generation. Then one
small list of all buckets and their generations is put in place by a rename, which makes the batch visible as a whole; what
comes of a batch that fails before is never listed, and a replayed batch starts from the same list and gives the same. So a
batch reads and writes in proportion to its keys, not to the batches before it, and readers see one row per key without
merging. Generations that neither the newest list nor the one before names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

BUCKETS = 32


class BucketedTable:
    """``merge`` turns rows of old and new states into one row per key; all rows of a ``bucket_key`` share a bucket."""

    def __init__(self, spark: SparkSession, folder: str, bucket_key: str, merge: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.bucket_key, self.merge, self.buckets = spark, folder.rstrip("/"), bucket_key, merge, buckets
        self.empty: DataFrame | None = None
        self.fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, kind: str) -> list[str]:
        where = self._path(f"{self.folder}/{kind}")
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def _lists(self) -> list[int]:
        return sorted(int(name) for name in self._names("lists") if name.isdigit())

    def _listed(self, number: int) -> dict[int, int]:
        """Bucket to the batch that wrote its newest generation: at most ``buckets`` entries."""
        rows = self.spark.read.schema("bucket int, generation bigint").json(f"{self.folder}/lists/{number}").collect()
        return {r["bucket"]: r["generation"] for r in rows}

    def _rows(self, buckets: dict[int, int]) -> DataFrame | None:
        paths = [f"{self.folder}/rows/{generation}/_bucket={bucket}" for bucket, generation in sorted(buckets.items())]
        return self.spark.read.schema(self.spark.read.parquet(paths[0]).schema).parquet(*paths) if paths else None

    def read(self) -> DataFrame | None:
        """One row per key as of the newest batch; None before the first."""
        lists = self._lists()
        return self._rows(self._listed(lists[-1])) if lists else None

    def add(self, updates: DataFrame, number: int) -> DataFrame:
        """Merge a batch, once or again; gives the merged rows of the buckets that it touched."""
        before = [n for n in self._lists() if n < number]
        listed = self._listed(before[-1]) if before else {}
        bucket = F.pmod(F.xxhash64(self.bucket_key), F.lit(self.buckets)).cast("int")
        updates = updates.withColumn("_bucket", bucket)
        target = f"{self.folder}/rows/{number}"
        touched = [r[0] for r in updates.select("_bucket").distinct().collect()]  # at most the number of buckets
        old = self._rows({b: listed[b] for b in touched if b in listed})
        rows = updates.drop("_bucket")
        merged = self.merge(rows if old is None else old.unionByName(rows))
        merged.withColumn("_bucket", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(target)
        following = listed | dict.fromkeys(touched, number)
        self._put(following, number)
        self._clean(following, listed)
        return self._rows({b: number for b in touched}) if touched else merged.limit(0)

    def _put(self, listed: dict[int, int], number: int) -> None:
        draft, final = self._path(f"{self.folder}/drafts/{number}"), self._path(f"{self.folder}/lists/{number}")
        rows = self.spark.createDataFrame(sorted(listed.items()), "bucket int, generation bigint")
        rows.coalesce(1).write.mode("overwrite").json(draft.toString())
        self.fs.mkdirs(final.getParent())
        self.fs.delete(final, True)
        if not self.fs.rename(draft, final):
            raise OSError(f"could not rename {draft} to {final}")

    def _clean(self, newest: dict[int, int], before: dict[int, int]) -> None:
        used = {str(g) for g in [*newest.values(), *before.values()]}
        for name in self._names("rows"):
            if name not in used:
                self.fs.delete(self._path(f"{self.folder}/rows/{name}"), True)
        for number in self._lists()[:-2]:
            self.fs.delete(self._path(f"{self.folder}/lists/{number}"), True)
