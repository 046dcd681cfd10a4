"""Region boxes: seam split, pruning, point-in-box join, lookup."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.space import box_contains, lon_360, lon_intervals

# A box table is broadcast up to this many (box, tile) rows: about 20 MB as a hash relation.
MAX_BROADCAST_TILES = 200_000
# Tile edges in degrees, finest first. Each divides 360, and the fractions are exact.
TILE_DEGREES = (0.125, 0.25, 0.5, 1, 3, 10, 30, 90)
# Tiles that a box should take on average; a few boxes together may take more.
TILES_PER_BOX, FREE_TILES = 9, 50_000
# A cover has at most so many rectangles, merged from at most so many boxes or from one per cell of the globe.
COVER, COVER_BOXES, COVER_DEGREES = 16, 64, 30
# Degrees by which a cover is wider than its boxes: more than float columns lose.
EDGE = 1e-3

# (lat_lo, lat_hi, lon_lo, lon_hi), longitudes in [0, 360]
Rectangle = tuple[float, float, float, float]


def region_intervals(regions: DataFrame) -> DataFrame:
    """One row per region and longitude interval in [0, 360]: 1 or 2 per region, bounds sorted."""
    return regions.select(
        "region_id",
        F.least("lat_min", "lat_max").alias("lat_lo"),
        F.greatest("lat_min", "lat_max").alias("lat_hi"),
        F.inline(lon_intervals("lon_min", "lon_max")).alias("lon_lo", "lon_hi"),
    )


def within_boxes(points: DataFrame, boxes: Sequence[tuple], lon_domain: str = "360") -> DataFrame:
    """Rows inside at least one of a few literal boxes (lat_min, lat_max, lon_min, lon_max).

    All bounds fold to constants, so the filter is pushed to the Parquet scan.
    """
    inside = [box_contains("lat", "lon", *box, domain=lon_domain) for box in boxes]
    return points.where(reduce(lambda a, b: a | b, inside))


def _area(r: Rectangle) -> float:
    return (r[1] - r[0]) * (r[3] - r[2])


def _hull(a: Rectangle, b: Rectangle) -> Rectangle:
    return min(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), max(a[3], b[3])


def box_cover(regions: DataFrame, most: int = COVER) -> list[Rectangle]:
    """At most ``most`` rectangles that hold all boxes, whatever their number.

    Many boxes are first gathered by the cell of the globe they start in, so what reaches the driver is
    bounded. Then the two rectangles whose hull adds the least area become one until few are left.
    """
    bounds = ("lat_lo", "lat_hi", "lon_lo", "lon_hi")
    intervals = region_intervals(regions).select(*bounds)
    found = intervals.limit(COVER_BOXES + 1).collect()
    if len(found) > COVER_BOXES:
        cells = [F.floor(F.col(c) / COVER_DEGREES) for c in ("lat_lo", "lon_lo")]
        found = intervals.groupBy(*cells).agg(*[(F.max if c.endswith("hi") else F.min)(c).alias(c) for c in bounds]).select(*bounds).collect()
    cover = sorted({tuple(r) for r in found if None not in r})
    while len(cover) > max(1, most):
        _, i, j = min(
            (_area(_hull(a, b)) - _area(a) - _area(b), i, i + 1 + j) for i, a in enumerate(cover) for j, b in enumerate(cover[i + 1:]))
        hull = _hull(cover[i], cover[j])
        cover = sorted({*(r for k, r in enumerate(cover) if k not in (i, j)), hull})
    return cover


def in_cover(lat: str, lon: str, cover: Sequence[Rectangle]) -> Column:
    """Holds for every point of every box of the cover, and for few others; longitudes may be in any domain.

    Bounds are literals on the columns themselves, so both latitudes and longitudes reach the Parquet scan.
    The exact test has to follow.
    """
    lats, lons = F.col(lat), F.col(lon)
    inside = F.lit(False)
    for lat_lo, lat_hi, lon_lo, lon_hi in cover:
        here = reduce(lambda a, b: a | b, [lons.between(lon_lo + turn - EDGE, lon_hi + turn + EDGE) for turn in (0.0, -360.0)])
        inside |= lats.between(lat_lo - EDGE, lat_hi + EDGE) & here
    if not cover:
        return inside
    # beyond one turn either way, as few data are, the latitude alone decides
    south, north = min(r[0] for r in cover), max(r[1] for r in cover)
    beyond = (lons >= 360.0 - EDGE) | (lons <= -360.0 + EDGE)
    return inside | (lats.between(south - EDGE, north + EDGE) & beyond)


def _span(lo: str, hi: str, degrees: float):
    return F.floor(F.col(lo) / degrees).cast("int"), F.floor(F.col(hi) / degrees).cast("int")


def _tile_degrees(intervals: DataFrame) -> tuple[float, int]:
    """The finest tile size at which boxes take few tiles each, and how many (box, tile) rows that is.

    Tiles follow the size of the boxes and not their number: about as large as a box or smaller,
    so that a point meets little more than the boxes that hold it. One small aggregate over the box
    table; the points are not touched.
    """
    def tiles(degrees: float):
        (y0, y1), (x0, x1) = _span("lat_lo", "lat_hi", degrees), _span("lon_lo", "lon_hi", degrees)
        return F.coalesce(F.sum((y1 - y0 + 1).cast("bigint") * (x1 - x0 + 1)), F.lit(0))

    boxes, *counts = intervals.agg(F.count("*"), *[tiles(d) for d in TILE_DEGREES]).first()
    most = max(FREE_TILES, TILES_PER_BOX * boxes)
    return next(((d, n) for d, n in zip(TILE_DEGREES, counts) if n <= most), (TILE_DEGREES[-1], counts[-1]))


def assign_regions(points: DataFrame, regions: DataFrame, max_broadcast: int = MAX_BROADCAST_TILES) -> DataFrame:
    """Each point once per region whose box holds it; points outside all boxes drop out.

    Boxes and points meet on a tile key, so the join is an equi-join whatever the number of
    boxes, and the exact box test runs on the candidates of one tile only. The tile table is
    broadcast if its counted size allows. Otherwise both sides shuffle on the tile, and the adaptive
    planner splits a tile that holds most of the points over many tasks.
    """
    intervals = region_intervals(regions)
    degrees, n_tiles = _tile_degrees(intervals)
    (y0, y1), (x0, x1) = _span("lat_lo", "lat_hi", degrees), _span("lon_lo", "lon_hi", degrees)
    tiles = (
        intervals.withColumn("tile_y", F.explode(F.sequence(y0, y1)))
        .withColumn("tile_x", F.explode(F.sequence(x0, x1)))
    )
    points = (
        points.withColumn("lon_360", lon_360("lon"))
        .withColumn("tile_y", F.floor(F.col("lat") / degrees).cast("int"))
        .withColumn("tile_x", F.floor(F.col("lon_360") / degrees).cast("int"))
    )
    keys = ["tile_y", "tile_x"]
    if n_tiles <= max_broadcast:
        tiles = F.broadcast(tiles)
    inside = F.col("lat").between(F.col("lat_lo"), F.col("lat_hi")) & F.col("lon_360").between(
        F.col("lon_lo"), F.col("lon_hi")
    )
    return points.join(tiles, keys).where(inside).drop(*keys, "lon_360", "lat_lo", "lat_hi", "lon_lo", "lon_hi")


def lookup_regions(requests: DataFrame, regions: DataFrame) -> DataFrame:
    """Requests with the box of their region; ``region_known`` tells whether there is one.

    No broadcast hint: Spark broadcasts the region table when its measured size allows.
    """
    known = regions.withColumn("region_known", F.lit(True))
    return requests.join(known, "region_id", "left").withColumn(
        "region_known", F.coalesce("region_known", F.lit(False))
    )
