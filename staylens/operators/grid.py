"""Area bounding boxes, sub-box grids and point-in-cell assignment
(sections 2.4, 2.5, 2.8, 2.9).

The reference delegates the per-box search to a web API; here the listing
coordinates are a table, and the "search" is the range join of points with
cells.  Cells of a d x d grid are equal-width, so arithmetic narrows a point to
the cells around ``floor((lat - sw) / step)`` and the cells' own bounds decide:
an equi-join with one row per area, no fan-out over d x d cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalar import BBOX_DECIMALS, BBOX_HALF_WIDTH, fixed_round

GRID_DIMENSIONS = 2
# A box returning this many hits was capped by the search service.
SATURATION_HITS = 280


def area_bbox(centroids: DataFrame, half_width: float = BBOX_HALF_WIDTH, decimals: int = BBOX_DECIMALS,
              area: str = "area", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Centroid +- half width, rounded: ``area, ne_lat, sw_lat, ne_lon, sw_lon``."""
    return centroids.select(
        area,
        fixed_round(F.col(lat) + half_width, decimals).alias("ne_lat"),
        fixed_round(F.col(lat) - half_width, decimals).alias("sw_lat"),
        fixed_round(F.col(lon) + half_width, decimals).alias("ne_lon"),
        fixed_round(F.col(lon) - half_width, decimals).alias("sw_lon"))


def bbox_grid(bbox: DataFrame, dimensions: int = GRID_DIMENSIONS, area: str = "area") -> DataFrame:
    """d x d sub-boxes per area, row-major (i over latitude, j over longitude)."""
    lat_step = (F.col("ne_lat") - F.col("sw_lat")) / dimensions
    lon_step = (F.col("ne_lon") - F.col("sw_lon")) / dimensions
    rng = F.sequence(F.lit(0), F.lit(dimensions - 1))
    g = bbox.select(area, "ne_lat", "sw_lat", "ne_lon", "sw_lon", lat_step.alias("lat_step"),
                    lon_step.alias("lon_step"), F.explode(rng).alias("cell_row")) \
        .select("*", F.explode(rng).alias("cell_col"))
    return g.select(
        area, "cell_row", "cell_col", (F.col("cell_row") * dimensions + F.col("cell_col")).alias("cell_no"),
        (F.col("sw_lat") + F.col("cell_row") * F.col("lat_step")).alias("box_sw_lat"),
        (F.col("sw_lon") + F.col("cell_col") * F.col("lon_step")).alias("box_sw_lon"),
        (F.col("sw_lat") + F.col("cell_row") * F.col("lat_step") + F.col("lat_step")).alias("box_ne_lat"),
        (F.col("sw_lon") + F.col("cell_col") * F.col("lon_step") + F.col("lon_step")).alias("box_ne_lon"),
        "sw_lat", "sw_lon", "lat_step", "lon_step")


def _candidates(point: str, sw: str, step: str, dimensions: int):
    """Cell numbers of one axis that may hold a point: the quotient's floor and
    its neighbours, as rounding can put a point on an edge beside it."""
    k = F.floor((F.col(point) - F.col(sw)) / F.col(step)).cast("int")
    return F.explode(F.sequence(F.greatest(F.lit(0), k - 1), F.least(F.lit(dimensions - 1), k + 1)))


def grid_range_join(points: DataFrame, cells: DataFrame, dimensions: int = GRID_DIMENSIONS,
                    area: str = "area", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points inside each cell of a :func:`bbox_grid`: ``box_sw <= p < box_ne``
    on both axes.

    A point joins its area's box (one row per area), takes at most three rows and
    then at most three columns of the grid as candidates, and keeps those whose
    own bounds, computed as in the grid, hold it.  The work per point does not
    grow with the number of cells."""
    box = cells.where((F.col("cell_row") == 0) & (F.col("cell_col") == 0)).select(
        area, F.col("sw_lat").alias("_sw_lat"), F.col("sw_lon").alias("_sw_lon"), F.col("lat_step").alias("_dlat"),
        F.col("lon_step").alias("_dlon"))
    out = points.join(box, area)
    for axis, sw, step, cell, low, high in ((lat, "_sw_lat", "_dlat", "cell_row", "box_sw_lat", "box_ne_lat"),
                                            (lon, "_sw_lon", "_dlon", "cell_col", "box_sw_lon", "box_ne_lon")):
        # a box without extent has no inside; a point outside it has no candidate
        near = (F.col(step) > 0) & (F.col(axis) >= F.col(sw)) & (F.col(axis) < F.col(sw) + (dimensions + 1) * F.col(step))
        out = out.where(near).select("*", _candidates(axis, sw, step, dimensions).alias(cell))
        out = out.withColumn(low, F.col(sw) + F.col(cell) * F.col(step)).withColumn(high, F.col(low) + F.col(step))
        out = out.where((F.col(cell) < dimensions) & (F.col(axis) >= F.col(low)) & (F.col(axis) < F.col(high)))
    return out.withColumn("cell_no", F.col("cell_row") * dimensions + F.col("cell_col")).select(
        *points.columns, "cell_row", "cell_col", "cell_no", "box_sw_lat", "box_sw_lon", "box_ne_lat", "box_ne_lon")


def grid_saturation(hits: DataFrame, threshold: int = SATURATION_HITS, area: str = "area") -> DataFrame:
    """Hits per cell; ``saturated`` when a cell reaches the search cap."""
    return hits.groupBy(area, "cell_no").agg(F.count(F.lit(1)).alias("hits")) \
        .withColumn("saturated", F.col("hits") >= threshold)


def union_cells(*cell_results: DataFrame, dedup_key: str | None = None) -> DataFrame:
    """Append per-cell results with no de-duplication (boundary hits repeat);
    ``dedup_key`` optionally keeps one row per listing."""
    out = cell_results[0]
    for r in cell_results[1:]:
        out = out.unionByName(r)
    return out.dropDuplicates([dedup_key]) if dedup_key else out
