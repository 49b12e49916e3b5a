"""Rows of two streams that rows of a later micro-batch may still join, kept as parquet folders.

Spark's own join of streams puts every row into a state store, key by key, and looks through the whole store for what has
expired: most of a core's time for rows that mostly meet nothing. Here a micro-batch is written once, as a table, and
joined as one; of earlier ones those rows alone are read that lie within reach of its times. A folder goes
when the watermark has passed all of its rows. Rows are dropped as late by the watermark of the batch before, as Spark does.

``root/batch=N/fresh=true`` holds the rows of micro-batch N. Where many folders are open, their open rows are gathered
in ``root/batch=N/fresh=false``, which then stands for all folders before N. A batch tried again finds the
folders before it as they were, and replaces its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Open folders that are gathered in one; what is open is written anew once in so many micro-batches.
FOLDERS = 64


class OpenRows:
    """The open rows of a left and a right side in one table, told apart by ``left``.

    ``times`` names the columns of their times in milliseconds, left and right. A right row is within reach of a left one
    from ``lower_ms`` to ``upper_ms`` after it, both included.
    """

    def __init__(self, root: str, times: tuple[str, str], lower_ms: int, upper_ms: int, folders: int = FOLDERS):
        self.root, self.times, self.folders = root.rstrip("/"), times, folders
        self.lower_ms, self.upper_ms = lower_ms, upper_ms

    def meet(self, rows: DataFrame, batch_id: int, late_ms: int) -> tuple[DataFrame, DataFrame]:
        """Keep the rows of a micro-batch; both sides of what is to be joined for it, with ``_fresh`` rows and earlier ones.

        Pairs of which neither row is fresh were found before. ``late_ms`` is the watermark rows are late by.
        """
        spark, schema, at = rows.sparkSession, rows.schema, [F.col(c) for c in self.times]
        own = f"{self.root}/batch={batch_id}"
        older = self._standing(spark, batch_id)
        self._delete(spark, own)
        if len(older) >= self.folders:
            held = self._read(spark, schema, older).where(self._open(late_ms)).select(rows.columns)
            held.write.parquet(f"{own}/fresh=false")
            older = [f"{own}/fresh=false"]
        in_time = F.coalesce(*at) > late_ms if late_ms > 0 else F.lit(True)
        rows.where(in_time).write.parquet(f"{own}/fresh=true")
        fresh = self._read(spark, schema, [f"{own}/fresh=true"])
        first, last, low, high = fresh.agg(*(f(c) for c in at for f in (F.min, F.max))).first()
        both = fresh.select(*rows.columns, F.lit(True).alias("_fresh"))
        if older:
            near = [F.lit(False), F.lit(False)]
            if low is not None:
                near[0] = at[0].between(low - self.upper_ms, high - self.lower_ms)
            if first is not None:
                near[1] = at[1].between(first + self.lower_ms, last + self.upper_ms)
            held = self._read(spark, schema, older).where(F.when(F.col("left"), near[0]).otherwise(near[1]))
            both = both.unionByName(held.select(*rows.columns, F.lit(False).alias("_fresh")))
        return both.where("left"), both.where("not left")

    def vacuum(self, spark: SparkSession, schema, batch_id: int, late_ms: int) -> None:
        """Delete the folders that neither a later micro-batch nor another try of this one reads."""
        standing = self._standing(spark, batch_id)
        needed = {path.split("/")[-2] for path in standing}
        for batch in self._batches(spark):
            if batch < batch_id and f"batch={batch}" not in needed:
                self._delete(spark, f"{self.root}/batch={batch}")
        if late_ms <= 0 or not standing:
            return
        # a number for each folder
        some = self._read(spark, schema, standing).where(self._open(late_ms)).select("batch").distinct()
        for name in needed - {f"batch={r.batch}" for r in some.collect()}:
            self._delete(spark, f"{self.root}/{name}")

    def _open(self, late_ms: int) -> Column:
        """Whether a row may meet one that comes in time."""
        left, right = (F.col(c) for c in self.times)
        return F.when(F.col("left"), left + self.upper_ms > late_ms).otherwise(right - self.lower_ms > late_ms)

    def _read(self, spark: SparkSession, schema, paths: list[str]) -> DataFrame:
        return spark.read.schema(f"{_ddl(schema)}, batch bigint, fresh boolean").option("basePath", self.root).parquet(*paths)

    def _batches(self, spark: SparkSession) -> dict[int, list[str]]:
        """The folders of every micro-batch, ``fresh=false`` first."""
        jvm, system = spark.sparkContext._jvm, self._system(spark)
        found = system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch=*/fresh=*")) or []
        out: dict[int, list[str]] = {}
        for path in sorted(f"{status.getPath().getParent().getName()}/{status.getPath().getName()}" for status in found):
            out.setdefault(int(path.split("/")[0].split("=")[1]), []).append(path)
        return out

    def _standing(self, spark: SparkSession, before: int) -> list[str]:
        """The folders that hold the rows of all micro-batches below ``before``."""
        out: list[str] = []
        for batch, paths in sorted(self._batches(spark).items()):
            if batch < before:
                whole = any(path.endswith("false") for path in paths)
                out = ([] if whole else out) + [f"{self.root}/{path}" for path in paths]
        return out

    def _system(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, spark: SparkSession, path: str) -> None:
        self._system(spark).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
