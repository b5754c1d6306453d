"""A ride store laid out along a space-filling curve (F1-F8 data skipping).

Rides are written in the order of a Z-order key of one ride end, so that every
row group holds a small area of the map. Parquet keeps the least and greatest
coordinate of each row group, and a zone filter, which reaches the scan as it
is, leaves out all row groups whose area it does not meet. Nothing changes for
readers: the store is plain Parquet with the columns of the rides.

Rides without a place in the frame (NULL, NaN, outside) lie together before all
others, so that they widen the area of no other row group but one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import NYC_BB
from ..operators.zones import SIDES

#: Bits a coordinate of the key has: 65,536 steps over the frame, some 2 m.
KEY_BITS = 16


def _spread(x: Column, bits: int = KEY_BITS) -> Column:
    """The lowest ``bits`` bits of a long, each moved to twice its place."""
    out = F.lit(0).cast("long")
    for k in range(bits):
        out = out.bitwiseOR(F.shiftleft(x.bitwiseAND(F.lit(1 << k).cast("long")), k))
    return out


def z_order_key(lon: str, lat: str, bb=NYC_BB, bits: int = KEY_BITS) -> Column:
    """The place of a point on the Z curve over the frame ``bb``: the bits of its
    column and row by turns. -1 outside the frame and where a coordinate is NULL
    or NaN."""
    def step(c: str, lo: float, hi: float) -> Column:
        at = F.floor((F.col(c).cast("double") - lo) / (hi - lo) * (1 << bits)).cast("long")
        return F.least(at, F.lit((1 << bits) - 1).cast("long"))  # the last edge belongs to the frame

    inside = F.col(lon).between(bb[0], bb[1]) & F.col(lat).between(bb[2], bb[3])
    key = _spread(step(lon, bb[0], bb[1]), bits).bitwiseOR(F.shiftleft(_spread(step(lat, bb[2], bb[3]), bits), 1))
    return F.when(F.coalesce(inside, F.lit(False)), key).otherwise(F.lit(-1).cast("long"))


def write_rides_clustered(df: DataFrame, path: str, side: str = "pickup", files: int | None = None, bb=NYC_BB,
                          row_group_bytes: int | None = None, mode: str = "overwrite") -> None:
    """Rides in the order of the Z curve of their ``side`` end, in ``files``
    files (as many as the session shuffles into by default).

    One range exchange. A place that holds a third of all rides does not fall
    to one task: equal keys are told apart by the hash of the row.
    """
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}, got {side!r}")
    keyed = df.withColumn("_z", z_order_key(f"{side}_longitude", f"{side}_latitude", bb)).withColumn("_h", F.xxhash64(*df.columns))
    dealt = keyed.repartitionByRange(files, "_z", "_h") if files else keyed.repartitionByRange("_z", "_h")
    writer = dealt.sortWithinPartitions("_z").drop("_z", "_h").write.mode(mode)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
