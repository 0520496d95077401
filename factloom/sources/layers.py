"""Tables of the bronze, silver, gold and seeds layers, as Parquet below one root."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("seeds", "bronze", "silver", "gold")

# Documents run to tens of megabytes. A reader holds the rows of one row group at a time,
# and the writer's own size check looks at compressed bytes and only every 100 rows, so
# the group is limited by rows.
WIDE_ROW_OPTIONS = {
    "parquet.block.row.count.limit": "8",
    "parquet.page.size.row.check.min": "1",
}


# Below a table's folder: a folder for each version, and a file that names the current one.
POINTER = "CURRENT"


class LayerStore:
    """Tables that a rebuild replaces at once.

    A rebuild writes a folder of its own and then switches the pointer, by one rename. Until
    then, and when it fails, readers see the version before. That one is kept until the next
    rebuild, so a reader that has begun finishes on the one it began with. One writer a table.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition_by: tuple[str, ...] = (),
        wide_rows: bool = False,
    ) -> DataFrame:
        """Full rebuild of one table; returns the written table, so lineage ends here."""
        version = f"v-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        writer = df.write.options(**(WIDE_ROW_OPTIONS if wide_rows else {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path(layer, name)}/{version}")
        self._switch(layer, name, version)
        return self.read(layer, name)

    def write_bucketed(
        self, df: DataFrame, layer: str, name: str, column: str, buckets: int, sort_by: tuple[str, ...] = ()
    ) -> DataFrame:
        """Full rebuild of one table in buckets by `column`, sorted within; returns it as a table.

        A bucket is one file, dealt by the hash that joins, windows and groupings by the column
        deal by; they read the table without an exchange. Parquet does not know of buckets, the
        catalog does: the table is `layer.name` there, and `register_bucketed` declares it in
        another session.
        """
        version = f"v-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        path, scratch = f"{self.path(layer, name)}/{version}", f"bucketed_{uuid.uuid4().hex}"
        writer = df.repartition(buckets, column).write.format("parquet").option("path", path)
        writer.bucketBy(buckets, column).sortBy(column, *sort_by).saveAsTable(scratch)
        # The entry is of no more use, and its files are not the catalog's.
        self.spark.sql(f"DROP TABLE {scratch}")
        self._switch(layer, name, version)
        return self.register_bucketed(layer, name, column, buckets, sort_by)

    def register_bucketed(
        self, layer: str, name: str, column: str, buckets: int, sort_by: tuple[str, ...] = ()
    ) -> DataFrame:
        """Make the current version of a bucketed table known; again after a rebuild."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
        columns = self.read(layer, name).schema.toDDL()
        order = ", ".join([column, *sort_by])
        self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
        self.spark.sql(
            f"CREATE TABLE {layer}.{name} ({columns}) USING parquet CLUSTERED BY ({column}) "
            f"SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{self.current(layer, name)}'"
        )
        return self.spark.table(f"{layer}.{name}")

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.current(layer, name))

    def current(self, layer: str, name: str) -> str:
        """Folder of the version that readers get."""
        folder = self.path(layer, name)
        pointer = self.spark.read.text(f"{folder}/{POINTER}").first()
        return f"{folder}/{pointer[0]}"

    def register(self, layer: str, name: str, partitioned: bool = False) -> None:
        """Make the current version visible to SQL as `layer.name`; again after a rebuild."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
        # The files are not the catalog's: dropping the entry leaves them.
        self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
        self.spark.sql(
            f"CREATE TABLE {layer}.{name} USING parquet LOCATION '{self.current(layer, name)}'"
        )
        if partitioned:
            self.spark.sql(f"MSCK REPAIR TABLE {layer}.{name}")

    def _switch(self, layer: str, name: str, version: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        hadoop = jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path(layer, name))
        files = folder.getFileSystem(conf)
        before = None
        if files.exists(hadoop.Path(folder, POINTER)):
            before = self.current(layer, name).rpartition("/")[2]
        point_to(self.spark, self.path(layer, name), version)
        for status in files.listStatus(folder):
            old = status.getPath().getName()
            if old.startswith("v-") and old < version and old != before:
                files.delete(hadoop.Path(folder, old), True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the driver's own, such as a pointer or a manifest."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def point_to(spark: SparkSession, folder: str, version: str) -> None:
    """Make `version` the one that readers of `folder` get.

    An overwriting rename is one step to every reader.
    """
    fresh = f"{folder}/.{version}.pointer"
    put_text(spark, fresh, version)
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(
        hadoop.Path(folder).toUri(), spark._jsc.hadoopConfiguration()
    ).rename(hadoop.Path(fresh), hadoop.Path(folder, POINTER), options)
