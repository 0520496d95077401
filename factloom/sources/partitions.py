"""Tables that are changed partition by partition."""

from __future__ import annotations

import functools
import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.session import discard, stored
from factloom.sources.layers import POINTER, point_to, put_text

COMMIT = "commit"


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of all keys, nulls among them."""
    return functools.reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


class PartitionedTable:
    """A Parquet table whose partitions a merge replaces one by one.

    `data/<partition>/commit=<id>` holds the rows of a partition as one commit wrote them. A
    manifest names the commit in force for each partition, and a pointer names the manifest.
    A merge writes only the partitions it touches, then a manifest, then switches the pointer
    by one rename: readers see all of it or nothing, a failed merge leaves the state before, and
    files of other partitions stay as they are. The state before the last one is kept for
    readers that have begun. One writer a table.
    """

    def __init__(self, spark: SparkSession, folder: str, partition_by: tuple[str, ...]):
        self.spark, self.folder, self.partition_by = spark, folder.rstrip("/"), list(partition_by)

    def exists(self) -> bool:
        return self._files().exists(self._path(f"{self.folder}/{POINTER}"))

    def properties(self) -> dict:
        """What the last commit noted beside its rows, such as the input it goes up to."""
        return self._manifest()["properties"]

    def read(self) -> DataFrame:
        return self._rows(self._manifest())

    def paths(self) -> list[str]:
        """Folders of the partitions in force."""
        return self._paths(self._manifest())

    def replace(self, rows: DataFrame, **properties) -> DataFrame:
        """The whole table anew."""
        return self._commit(rows, {}, rows.schema.json(), properties)

    def merge(
        self, rows: DataFrame, keys: list[str], removed: DataFrame | None = None, **properties
    ) -> DataFrame:
        """Rows with the keys of `rows` or `removed` go, then `rows` come in.

        A row that goes must stand in a partition that `rows` or `removed` name, which is so
        where the keys decide the partition; `removed` has the keys and the partition columns.
        Only those partitions are read and written. Without a table yet, `rows` are the table.
        Properties not given stay. Null keys equal each other.
        """
        if not self.exists():
            return self.replace(rows, **properties)
        before = self._manifest()
        rows = stored(self.spark, rows, "merge")
        placed = [*keys, *[p for p in self.partition_by if p not in keys]]
        gone = rows.select(*placed)
        if removed is not None:
            gone = gone.unionByName(removed.select(*placed))
        gone = stored(self.spark, gone.distinct(), "merged_keys")
        # As many as there are partitions.
        touched = {self._name(r) for r in gone.select(*self.partition_by).distinct().collect()}
        kept = {n: c for n, c in before["partitions"].items() if n not in touched}
        old = self._rows({**before, "partitions": {n: c for n, c in before["partitions"].items() if n in touched}})
        keyed = gone.select(*keys).distinct()
        after = old.join(keyed, same_keys(old, keyed, keys), "left_anti").unionByName(rows)
        result = self._commit(after, kept, before["schema"], {**before["properties"], **properties}, keys)
        discard(self.spark, rows, gone)
        return result

    def _commit(self, rows: DataFrame, kept: dict, schema: str, properties: dict, keys=()) -> DataFrame:
        commit = f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        # By ranges, so that a large partition is written by several tasks and a small one by one.
        order = [*self.partition_by, *[k for k in keys if k not in self.partition_by]]
        rows.withColumn(COMMIT, F.lit(commit)).repartitionByRange(*order).write.mode("append").partitionBy(
            *self.partition_by, COMMIT
        ).parquet(f"{self.folder}/data")
        depth = "/*" * len(self.partition_by)
        found = self._files().globStatus(self._path(f"{self.folder}/data{depth}/{COMMIT}={commit}"))
        names = [self._relative(f.getPath().getParent().toString()) for f in found or []]
        manifest = {
            "schema": schema, "properties": properties, "partitions": {**kept, **dict.fromkeys(names, commit)},
        }
        version = f"m-{commit}"
        put_text(self.spark, f"{self.folder}/{version}", json.dumps(manifest))
        last = self._current() if self.exists() else None
        point_to(self.spark, self.folder, version)
        self._clean({version, last})
        return self.read()

    def _clean(self, versions: set) -> None:
        files, keep = self._files(), set()
        for version in versions - {None}:
            keep |= set(self._paths(self._manifest(version)))
        for status in files.globStatus(self._path(f"{self.folder}/m-*")):
            if status.getPath().getName() not in versions:
                files.delete(status.getPath(), False)
        depth = "/*" * len(self.partition_by)
        keep = {self._relative(p) for p in keep}
        for status in files.globStatus(self._path(f"{self.folder}/data{depth}/{COMMIT}=*")) or []:
            if self._relative(status.getPath().toString()) not in keep:
                files.delete(status.getPath(), True)

    def _rows(self, manifest: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        paths = self._paths(manifest)
        if not paths:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())]))
        return read.option("basePath", f"{self.folder}/data").parquet(*paths).select(*schema.fieldNames())

    def _paths(self, manifest: dict) -> list[str]:
        return [f"{self.folder}/data/{n}/{COMMIT}={c}" for n, c in sorted(manifest["partitions"].items())]

    def _manifest(self, version: str | None = None) -> dict:
        return json.loads(self._text(f"{self.folder}/{version or self._current()}"))

    def _current(self) -> str:
        return self._text(f"{self.folder}/{POINTER}")

    def _text(self, path: str) -> str:
        return self.spark.read.text(path, wholetext=True).first()[0]

    def _name(self, values) -> str:
        """A partition's folder, as the writer names it."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        texts = [None if v is None else str(v) for v in values]
        return "/".join(map(escape.getPartitionPathString, self.partition_by, texts))

    def _relative(self, path: str) -> str:
        return path.rpartition(f"{self.folder.rpartition('/')[2]}/data/")[2]

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
