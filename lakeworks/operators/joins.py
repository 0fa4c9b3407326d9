"""Left joins that stay even when one key holds a large share of the rows, on either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.session import durable, estimated_bytes, shuffle_partitions

# Keys are looked for in about this many rows per partition; a key that fills a partition is met so often on average,
# and a candidate when it is met a quarter as often. Candidates are then counted exactly, over all rows.
LOOKED_AT = 32

# A right side up to this estimated size is broadcast; beyond it both sides are shuffled.
BROADCAST_BYTES = 16 << 20

SLOT = "_slot"


def with_row_slot(df: DataFrame) -> DataFrame:
    """Number the rows of a scan, to spread hot keys by.

    The number follows file order, not content (copies of one row must spread too), so attach it to
    a frame that is read and projected but not yet shuffled: a rerun task then gives the same numbers.
    """
    return df.withColumn(SLOT, F.monotonically_increasing_id())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the frame is small by Spark's size estimate; unknown sizes are not."""
    size = estimated_bytes(df)
    return size is not None and size <= BROADCAST_BYTES


def counted_small(df: DataFrame) -> bool:
    """Whether a settled frame of fixed-width columns and short keys fits a broadcast, by counted rows."""
    return df.count() * df._jdf.schema().defaultSize() <= BROADCAST_BYTES


class HotKeys:
    """The keys of a frame that hold more than one partition's share of its rows, as small tables.

    Found on first use: candidates come from a sample of the rows, bounded by the number of partitions, and one
    aggregate counts them over all rows. Fewer than one key per partition can be hot, and at most four per partition can
    be candidates, so both fit a broadcast; nothing is collected. The result only steers the layout of a join,
    which is exact whatever it holds.
    """

    def __init__(self, df: DataFrame, *keys: str, parts: int | None = None):
        self._df, self._keys, self._rows = df, keys, None
        self._found: dict[str, DataFrame | None] = {}
        self._parts = parts or shuffle_partitions(df.sparkSession)

    def of(self, key: str) -> DataFrame | None:
        """Each hot key with the ``_slots`` it needs, settled; None where no key is hot."""
        if key not in self._found:
            if self._rows is None:
                self._rows = self._df.count()
            found = durable(self._count(key)) if self._rows else None
            self._found[key] = None if found is None or found.isEmpty() else found
        return self._found[key]

    def _count(self, key: str) -> DataFrame:
        keyed = self._df.select(key).where(F.col(key).isNotNull())
        share = LOOKED_AT * self._parts / self._rows
        if share < 1:
            met = keyed.sample(share, seed=self._parts).groupBy(key).agg(F.count(F.lit(1)).alias("_met"))
            candidates = met.where(F.col("_met") >= LOOKED_AT // 4).select(key)
            keyed = keyed.join(F.broadcast(candidates), key, "left_semi")
        slots = F.expr(f"(count(1) * {self._parts} + {self._rows - 1}) div {self._rows}").cast("int")
        return keyed.groupBy(key).agg(slots.alias("_slots")).where("_slots > 1")


def _marked(df: DataFrame, hot: DataFrame | None, key: str, name: str) -> DataFrame:
    """``df`` with the slots of each row's key as ``name``, 1 for ordinary keys."""
    if hot is None:
        return df.withColumn(name, F.lit(1))
    known = df.join(F.broadcast(hot.withColumnRenamed("_slots", name)), key, "left")
    return known.withColumn(name, F.coalesce(name, F.lit(1)))


def _every(slots: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(slots) - 1))


def _own(row: str, slots: Column) -> Column:
    return F.pmod(F.col(row), slots).cast("int")


def skew_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    parts: int | None = None,
    hot_left: HotKeys | None = None,
    hot_right: HotKeys | None = None,
    unique_right: bool = False,
    sized_by: DataFrame | None = None,
    right_slot: str | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """``left.join(right, key, "left")`` with hot and null keys spread over many tasks.

    ``left`` carries a row slot. A ``right`` of checked small size is broadcast (unless ``broadcast`` is off). Otherwise each left
    row of a hot key takes one of the key's slots and the matching right rows are repeated per slot;
    null keys match nothing and spread freely. Keys that are hot on the right certainly match, so they
    go through an inner join in which each side is spread over its own slots and repeated over the
    other's. No row is dropped and each pair meets once.

    ``hot_left`` and ``hot_right`` may be taken from cheaper frames with about the same key
    distribution; every key of ``hot_right`` must occur in ``right``. ``unique_right`` tells that the
    right side has no repeated keys; ``sized_by`` is a stored frame at least as large as ``right``, for
    a right side made by joins, whose size Spark overestimates. ``right_slot`` names a row number
    taken when ``right`` was scanned; without it ``right`` must itself be read straight from storage.
    """
    scanned = [right_slot] if right_slot else []
    if broadcast and fits_broadcast(sized_by if sized_by is not None else right):
        return left.join(F.broadcast(right.drop(*scanned)), key, "left")
    parts = parts or shuffle_partitions(left.sparkSession)
    on_left = (hot_left or HotKeys(left, key, parts=parts)).of(key)
    on_right = None if unique_right else (hot_right or HotKeys(right, key, parts=parts)).of(key)
    usable = right.filter(F.col(key).isNotNull())

    def ordinary(df: DataFrame) -> DataFrame:
        return df if on_right is None else df.join(F.broadcast(on_right), key, "left_anti")

    slots = F.when(F.col(key).isNull(), F.lit(parts)).otherwise(F.col("_rows"))
    spread = _marked(ordinary(left), on_left, key, "_rows").withColumn("_a", _own(SLOT, slots)).drop("_rows")
    repeated = _marked(ordinary(usable).drop(*scanned), on_left, key, "_rows").withColumn("_a", _every("_rows")).drop("_rows")
    joined = spread.join(repeated, [key, "_a"], "left").drop("_a")
    if on_right is None:
        return joined

    def gridded(df: DataFrame) -> DataFrame:
        hot = df.join(F.broadcast(on_right.withColumnRenamed("_slots", "_columns")), key)
        return _marked(hot, on_left, key, "_rows")

    number = F.col(right_slot) if right_slot else F.monotonically_increasing_id()
    grid_left = gridded(left).withColumn("_a", _own(SLOT, F.col("_rows"))).withColumn("_b", _every("_columns"))
    grid_right = (
        gridded(usable.withColumn("_row", number))
        .withColumn("_b", _own("_row", F.col("_columns")))
        .withColumn("_a", _every("_rows"))
        .drop("_row", *scanned)
    )
    sides = (side.drop("_rows", "_columns") for side in (grid_left, grid_right))
    return joined.unionByName(next(sides).join(next(sides), [key, "_a", "_b"]).drop("_a", "_b"))
