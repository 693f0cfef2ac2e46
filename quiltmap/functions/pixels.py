"""Byte pixels: 0 is transparent, 1..255 is data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quiltmap.functions.grid import col

BANDS = ("r", "g", "b")
NODATA_BYTE = 128  # fixed value: what a no-data marker is read as


def byte_normalize(signed: Column | str) -> Column:
    """Signed byte to 0..255; a missing value becomes 128."""
    return F.when(col(signed).isNull(), NODATA_BYTE).otherwise(col(signed).bitwiseAND(F.lit(255))).cast("int")


def has_data(bands=BANDS) -> Column:
    return F.greatest(*[F.col(b) for b in bands], F.lit(0)) > 0


def rgba_pack(r="r", g="g", b="b") -> Column:
    """0xRRGGBBAA as a bigint; true black is fully transparent."""
    big = [col(c).cast("bigint") for c in (r, g, b)]
    rgba = F.shiftleft(big[0], 24).bitwiseOR(F.shiftleft(big[1], 16)).bitwiseOR(F.shiftleft(big[2], 8)).bitwiseOR(F.lit(255))
    blank = (col(r) == 0) & (col(g) == 0) & (col(b) == 0)
    return F.when(blank, F.lit(0).cast("bigint")).otherwise(rgba)
