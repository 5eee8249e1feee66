"""Join helpers: size-checked broadcast and grid-binned range joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flight_engine.functions.geo import grid_cell


def bounded_broadcast(small: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after proving ``small`` has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows.  Beyond the bound the
    frame is returned unhinted and the planner (AQE) picks a shuffle join.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def boxes_to_cells(boxes: DataFrame, deg: float, min_lat="min_lat", max_lat="max_lat",
                   min_lon="min_lon", max_lon="max_lon") -> DataFrame:
    """One row per (box, grid cell it overlaps); adds column ``cell``.

    Each box fans out to ceil(height/deg+1) * ceil(width/deg+1) cells, a
    constant per box, so the binned table grows with the box count only.
    """
    rows = int(round(180 / deg))
    cols = int(round(360 / deg))

    def band(c, off, n):
        return F.least(F.greatest(F.floor((F.col(c) + off) / deg), F.lit(0)), F.lit(n - 1))
    return (boxes
            .withColumn("_r", F.explode(F.sequence(band(min_lat, 90.0, rows), band(max_lat, 90.0, rows))))
            .withColumn("_c", F.explode(F.sequence(band(min_lon, 180.0, cols), band(max_lon, 180.0, cols))))
            .withColumn("cell", (F.col("_r") * cols + F.col("_c")).cast("bigint"))
            .drop("_r", "_c"))


def points_in_boxes(points: DataFrame, boxes: DataFrame, deg: float = 10.0,
                    how: str = "inner", max_boxes: int = 100_000) -> DataFrame:
    """Range join ``lat/lon`` inside ``[min,max]`` boxes as an equi-join on grid cells.

    Points get one cell id, boxes are replicated to the cells they cover,
    and the exact inclusive predicate is applied after the equi-join; no
    nested-loop join and no pairs outside a shared cell.  The binned box
    table is broadcast only when its row count is proven small.
    """
    binned = bounded_broadcast(boxes_to_cells(boxes, deg), max_boxes)
    p = points.withColumn("_cell", grid_cell("latitude", "longitude", deg))
    cond = ((p["_cell"] == binned["cell"])
            & p["latitude"].between(binned["min_lat"], binned["max_lat"])
            & p["longitude"].between(binned["min_lon"], binned["max_lon"]))
    return p.join(binned, cond, how).drop("_cell", "cell")
