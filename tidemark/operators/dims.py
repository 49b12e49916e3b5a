"""Dimension lookups: a left join from facts to one row per key."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.skew import FILE_EXPANSION, hot_keys, join_table
from tidemark.sources.staging import stage

CACHE_SECONDS = 24 * 60 * 60


# Rows the overlay of changed keys may hold before it is merged into the kept rows.
OVERLAY_ROWS = 1_000_000


class Dimension:
    """A dimension table and how fresh it is kept.

    ``refresh="batch"`` reads the source at every use (a stream uses it once per
    micro-batch). ``refresh="cached"`` reads once and keeps the rows on the executors until
    ``ttl_seconds`` have passed or :meth:`invalidate` is called. ``refresh="version"`` keeps them until
    ``version()``, a cheap look at the source, gives another value: an unchanged source is never read again.

    Kept rows of single keys are replaced by :meth:`replace`, without reading the source.
    """

    def __init__(
        self,
        reader: Callable[[], DataFrame],
        refresh: str = "batch",
        ttl_seconds: float = CACHE_SECONDS,
        version: Callable[[], object] | None = None,
        key: str = "id",
        overlay_rows: int = OVERLAY_ROWS,
    ):
        if refresh not in ("batch", "cached", "version"):
            raise ValueError(f"unknown refresh {refresh!r}")
        if (refresh == "version") != (version is not None):
            raise ValueError("version() is for refresh='version', which needs it")
        self._reader = reader
        self._refresh = refresh
        self._ttl = ttl_seconds
        self._version = version
        self._key = key
        self._overlay_rows = overlay_rows
        self._frame: DataFrame | None = None
        self._keys: DataFrame | None = None
        self._rows: DataFrame | None = None
        self._read_at: object = 0.0

    def frame(self) -> DataFrame:
        if self._refresh == "batch":
            return self._reader()
        # asked before the read: a change that comes between is then seen the next time
        version = self._version() if self._version else None
        if self._frame is not None and self._stale(version):
            self.invalidate()
        if self._frame is None:
            self._frame = self._reader().persist()
            self._read_at = version if self._version else time.monotonic()
        if self._keys is None:
            return self._frame
        return self._overlaid()

    def _stale(self, version: object) -> bool:
        if self._version:
            return version != self._read_at
        return time.monotonic() - self._read_at >= self._ttl

    def invalidate(self) -> None:
        """Forget the kept rows, after an update of the source."""
        for kept in (self._frame, self._keys, self._rows):
            if kept is not None:
                kept.unpersist()
        self._frame = self._keys = self._rows = None

    def replace(self, keys: DataFrame, rows: DataFrame) -> None:
        """Let ``rows`` stand for all kept rows whose key is in ``keys`` (a column named like the key).

        A key without a row is gone from the dimension. ``rows`` with other keys are not taken. The replaced
        keys are kept beside the rest, and merged with it once there are more than ``overlay_rows``. Where
        nothing is kept this does nothing: the next use reads the source.
        """
        if self._frame is None:
            return
        name = self._key
        keys = keys.select(F.col(name).cast(self._frame.schema[name].dataType)).dropna().distinct()
        rows = rows.select(self._frame.columns).join(keys, name, "left_semi")
        if self._keys is not None:
            rows = rows.unionByName(self._rows.join(keys, name, "left_anti"))
            keys = keys.unionByName(self._keys).distinct()
        # written out: neither the sources of the changes nor earlier overlays are asked again
        before = self._keys, self._rows
        self._keys, self._rows = stage(keys, "dimension-keys").persist(), stage(rows, "dimension-rows").persist()
        for kept in before:
            if kept is not None:
                kept.unpersist()
        if self._keys.count() > self._overlay_rows:
            merged = stage(self._overlaid(), "dimension").persist()
            read_at = self._read_at
            self.invalidate()
            self._frame, self._read_at = merged, read_at

    def _overlaid(self) -> DataFrame:
        """The kept rows without the replaced keys, and the rows that stand for them."""
        return self._frame.join(self._keys, self._key, "left_anti").select(self._frame.columns).unionByName(self._rows)


def _frame(dim: DataFrame | Dimension) -> DataFrame:
    return dim.frame() if isinstance(dim, Dimension) else dim


def first_rows(dim: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key, the first by ``order_by`` (default: all other columns).

    The limit also applies before the shuffle, so a key repeated many times sends one row
    per task.
    """
    order = order_by or [c for c in dim.columns if c not in keys]
    window = W.partitionBy(*keys).orderBy(*(order or keys))
    ranked = dim.withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").drop("_rank")


def enrich(
    facts: DataFrame,
    dim: DataFrame | Dimension,
    on: dict[str, str],
    columns: dict[str, str | Callable[[Callable[[str], Column]], Column]],
    order_by: list[str] | None = None,
    unique: bool = False,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Fill fact columns from the dimension row with equal keys.

    ``on`` maps fact columns to dimension columns; all of them must be equal as text.
    ``columns`` maps fact columns to a dimension column, or to a function building an
    expression from dimension columns. When no row matches the fact passes unchanged. Of
    several rows with the same key the first by ``order_by`` counts; ``unique`` says there
    are none, which saves looking.

    A dimension too large to send to the facts is joined by a shuffle. Keys with many facts
    are then split by adaptive execution, or, given ``rows_per_task``, counted first and
    salted. Counting reads the facts once more, so it is for facts that are a table.
    """
    keys = {f"_key{i}": pair for i, pair in enumerate(on.items())}
    source = _frame(dim)
    keyed = source.withColumns({k: F.col(d).cast("string") for k, (_, d) in keys.items()})
    keyed = keyed.dropna("any", subset=list(keys))
    if not unique:
        rest = [c for c in source.columns if c not in on.values()]
        keyed = first_rows(keyed, list(keys), order_by or rest or list(on.values()))

    def value(spec) -> Column:
        return F.col(spec) if isinstance(spec, str) else spec(F.col)

    table = keyed.select(
        *keys,
        F.lit(True).alias("_found"),
        *[value(spec).alias(f"_dim_{name}") for name, spec in columns.items()],
    )
    plain = facts.withColumns({k: F.col(f).cast("string") for k, (f, _) in keys.items()})
    hot = None if rows_per_task is None else hot_keys(plain, list(keys), rows_per_task)
    joined = join_table(plain, table, list(keys), "left", hot, FILE_EXPANSION)

    kinds = dict(facts.dtypes)
    filled = {}
    for name in columns:
        new = F.col(f"_dim_{name}")
        if name in kinds:
            new = F.when(F.col("_found"), new.cast(kinds[name])).otherwise(F.col(name))
        filled[name] = new
    kept = [c for c in facts.columns]
    added = [c for c in columns if c not in kinds]
    return joined.withColumns(filled).select(*kept, *added)


def get_dim(
    facts: DataFrame, dim: DataFrame | Dimension, fact_key: str, columns: dict, id_column: str = "id"
) -> DataFrame:
    """Lookup by a single id."""
    return enrich(facts, dim, {fact_key: id_column}, columns)
