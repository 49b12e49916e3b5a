"""Tables with one row per key that micro-batches upsert into, kept as parquet folders.

Keys are dealt to buckets by hash. A batch merges its rows with the touched buckets alone and writes
those anew, under its own number: ``root/batch=N/bucket=B``. A bucket's newest written batch is its
state. A batch tried again finds the buckets as they were before it and gives the same table, and readers
never see a batch half written, as it counts only once Spark has marked its folder as complete.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Buckets of a table; a bucket is merged and written by one task, so take more for larger tables.
BUCKETS = 64


class KeyedTable:
    """The newest row of each key, by ``order``; ``schema`` is DDL and names ``keys`` and ``order`` too."""

    def __init__(self, root: str, schema: str, keys: list[str], order: list[str], buckets: int = BUCKETS):
        self.root = root.rstrip("/")
        self.schema, self.keys, self.order, self.buckets = schema, keys, order, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row a key; combines before the shuffle."""
        columns = [c for c in rows.columns if c != "_bucket"]
        best = F.max_by(F.struct(*columns), F.struct(*self.order)).alias("_row")
        return rows.groupBy("_bucket", *[F.col(k).alias(f"_key_{k}") for k in self.keys]).agg(best).select("_bucket", "_row.*")

    def versions(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """The newest complete batch, below ``before``, of each bucket that has one."""
        found: dict[int, int] = {}
        for batch, buckets in sorted(self._batches(spark).items()):
            if before is None or batch < before:
                found |= dict.fromkeys(buckets, batch)
        return found

    def _batches(self, spark: SparkSession) -> dict[int, list[int]]:
        """The buckets in the folder of every complete batch."""
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out: dict[int, list[int]] = {}
        for batch in system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch=*/_SUCCESS")) or []:
            folder = batch.getPath().getParent()
            names = [status.getPath().getName() for status in system.listStatus(folder)]
            out[int(folder.getName().split("=")[1])] = [int(n.split("=")[1]) for n in names if n.startswith("bucket=")]
        return out

    def _read(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        paths = [f"{self.root}/batch={batch}/bucket={bucket}" for bucket, batch in sorted(versions.items())]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.versions(spark))

    def version(self, spark: SparkSession) -> int:
        """The newest complete batch; -1 for a table without any."""
        return max(self._batches(spark), default=-1)

    def upsert(self, rows: DataFrame, batch_id: int) -> list[int]:
        """Merge rows into the table; gives the touched buckets. Rows with a null key are left out.

        Of equal ``order`` either row may win.
        """
        spark = rows.sparkSession
        names = self._read(spark, {}).columns
        keyed = rows.select(names).dropna("any", subset=self.keys).withColumn("_bucket", self._bucket())
        fresh = self._newest(keyed).persist()
        try:
            # a number for each bucket at most, however many rows
            touched = sorted(r[0] for r in fresh.select("_bucket").distinct().collect())
            current = self.versions(spark, before=batch_id)
            held = self._read(spark, {b: current[b] for b in touched if b in current})
            merged = self._newest(fresh.unionByName(held.withColumn("_bucket", self._bucket())))
            placed = merged.withColumn("bucket", F.col("_bucket")).repartition(max(1, len(touched)), "_bucket").drop("_bucket")
            placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/batch={batch_id}")
        finally:
            fresh.unpersist()
        return touched

    def sink(self) -> Callable[[DataFrame, int], None]:
        """A micro-batch sink; what is behind the batch before is deleted."""

        def write(rows: DataFrame, batch_id: int) -> None:
            self.upsert(rows, batch_id)
            self.vacuum(rows.sparkSession, batch_id)

        return write

    def vacuum(self, spark: SparkSession, batch_id: int) -> int:
        """Delete bucket versions that neither the table nor another try of ``batch_id`` reads; gives their number."""
        kept = set(self.versions(spark).items()) | set(self.versions(spark, before=batch_id).items())
        jvm, conf, gone = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
        for batch, buckets in self._batches(spark).items():
            left = [b for b in buckets if (b, batch) in kept]
            # an emptied batch goes whole, so that folders do not pile up; the newest stays, it is the version
            old = [f"bucket={b}" for b in buckets if b not in left] if left or batch >= batch_id else [""]
            for name in old:
                path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch={batch}/{name}".rstrip("/"))
                path.getFileSystem(conf).delete(path, True)
                gone += 1
        return gone
