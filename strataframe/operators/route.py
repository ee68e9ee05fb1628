"""Points within a distance of a route, without comparing every point to every segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.errors import DeliveryError
from strataframe.session import broadcast_if_small, local_table

SEGMENT_SCHEMA = "x1 double, y1 double, x2 double, y2 double"
# A long segment is cut into parts this many cells long before its cells are listed, so that the
# box around a part stays small.
PART_CELLS = 8
# Into how many cells the whole route is cut at most if the distance is small.
ROUTE_CELLS = 100_000


def route_segments(spark: SparkSession, vertices: Sequence[tuple[float, float]]) -> DataFrame:
    """The segments of a line given by its vertices. A single vertex is a segment of no length."""
    points = [(float(x), float(y)) for x, y in vertices]
    if not points:
        raise DeliveryError("a route needs at least one vertex")
    ends = points[1:] or points
    return local_table(spark, [(*a, *b) for a, b in zip(points, ends)], SEGMENT_SCHEMA)


def segment_distance_squared(x: Column, y: Column) -> Column:
    """Squared distance from a point to the segment ``(x1, y1)-(x2, y2)`` of the same row."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length2 = dx * dx + dy * dy
    along = ((x - F.col("x1")) * dx + (y - F.col("y1")) * dy) / F.nullif(length2, F.lit(0.0))
    t = F.coalesce(F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    ox, oy = x - (F.col("x1") + t * dx), y - (F.col("y1") + t * dy)
    return ox * ox + oy * oy


def _route_cells(segments: DataFrame, distance: float, cell: float) -> DataFrame:
    """Grid cells that can hold a point within ``distance`` of a segment, next to that segment."""
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    n_parts = F.greatest(F.ceil(length / F.lit(PART_CELLS * cell)), F.lit(1)).cast("long")
    parts = segments.withColumn("n_parts", n_parts).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1))
    )

    def at(first: str, last: str, step: Column) -> Column:
        return F.col(first) + (F.col(last) - F.col(first)) * step / F.col("n_parts")

    def span(first: str, last: str) -> Column:
        a, b = at(first, last, F.col("part")), at(first, last, F.col("part") + 1)
        low = F.floor((F.least(a, b) - distance) / cell)
        high = F.floor((F.greatest(a, b) + distance) / cell)
        return F.sequence(low, high)

    boxed = parts.withColumn("cx", F.explode(span("x1", "x2"))).withColumn("cy", F.explode(span("y1", "y2")))
    centre_x, centre_y = (F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell
    # Half a cell's diagonal, with a margin for rounding.
    reach = distance + 0.7072 * cell
    near = segment_distance_squared(centre_x, centre_y) <= F.lit(reach * reach)
    return boxed.where(near).select("cx", "cy", "x1", "y1", "x2", "y2").distinct()


def _usual_cell(segments: DataFrame) -> float:
    """A cell so large that the whole route has at most about ``ROUTE_CELLS`` of them, however small the distance."""
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    total = segments.agg(F.sum(length)).first()[0] or 0.0
    return max(total / ROUTE_CELLS, 1e-9)


def near_route(points: DataFrame, x: str, y: str, segments: DataFrame, distance: float,
               cell: float | None = None) -> DataFrame:
    """The points at most ``distance`` from any segment, each once.

    Points and segments meet by grid cell in a semi-join, which checks the exact distance and never
    multiplies a point. The cells are broadcast if they turn out to be few; otherwise Spark shuffles
    both sides by cell.
    """
    size = cell or max(distance, _usual_cell(segments))
    if size < distance:
        raise DeliveryError("the grid cell must not be smaller than the distance")
    cells = broadcast_if_small(_route_cells(segments, distance, size))
    located = points.withColumn("_cx", F.floor(F.col(x) / size)).withColumn("_cy", F.floor(F.col(y) / size))
    within = segment_distance_squared(F.col(x), F.col(y)) <= F.lit(distance * distance)
    same_cell = (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy"))
    return located.join(cells, same_cell & within, "left_semi").drop("_cx", "_cy")
