"""Nearest place to each coordinate, exact, without comparing all pairs.

The globe is cut into cells that shrink by four per axis and level. Each
occupied cell keeps the places that may be nearest to some point in it: with
``r`` the radius of the cell about its centre and ``d`` the distance of the
place nearest to the centre, these are the places within ``d + 2r`` of the
centre (triangle inequality; straight lines through the globe, which need no
trigonometry per pair). A cell inherits the list of the cell around it,
so each level only thins out the lists of the one before. Cells with a short
list and not too many points are finished; the others are cut again. At the
end every point is compared with the short list of its own cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewise.functions.coordinates import great_circle_km, unit_vector
from statewise.workspace import settle

QUARTER = 90.0  # degrees: edge of the eight level-0 cells
DEEPEST = 11  # cells of about two metres
SHORT_LIST = 64
CELL_POINTS = 131_072
FIRST_PAIRS = 2_000_000
COARSE = 3  # at most 32,768 cells up to this level
SLACK = 1e-9  # of the earth's radius: far above rounding errors


def _index(degrees: Column, offset: float, quarters: int) -> Column:
    """Row or column of the deepest cell that holds the coordinate."""
    cells = 4**DEEPEST
    index = F.floor((degrees + offset) / QUARTER * cells).cast("int")
    # The north pole and the date line belong to the last cell.
    return F.least(index, F.lit(quarters * cells - 1))


def _row(level: int) -> Column:
    return F.shiftright(F.col("deep_row"), 2 * (DEEPEST - level))


def _col(level: int) -> Column:
    return F.shiftright(F.col("deep_col"), 2 * (DEEPEST - level))


def _on_globe(df: DataFrame) -> DataFrame:
    return df.where(
        F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    )


def _first_level(points: DataFrame, places: DataFrame) -> int:
    """Level to begin with: the finest whose cells times places are few.

    Only a matter of speed, so an approximate number of cells will do. Level 1,
    with its 128 cells at most, is taken when no finer one fits.
    """
    occupied = points.agg(
        *[
            F.approx_count_distinct(F.struct(_row(level), _col(level))).alias(str(level))
            for level in (1, 2, 3, 4)
        ]
    ).first()
    most_cells = FIRST_PAIRS // max(1, places.count())
    fitting = [level for level in (2, 3, 4) if occupied[str(level)] <= most_cells]
    return max(fitting, default=1)


def _cells(points: DataFrame, level: int) -> DataFrame:
    """Occupied cells of a level, with their number of points."""
    return points.groupBy(_row(level).alias("cell_row"), _col(level).alias("cell_col")).agg(
        F.count("*").alias("cell_points")
    )


def _placed(cells: DataFrame, level: int, above: int) -> DataFrame:
    """Cells with their centre, their radius and the cell of the level ``above``
    they lie in."""
    width = QUARTER / 4**level
    centre_lat = (F.col("cell_row") + 0.5) * width - 90
    centre_lon = (F.col("cell_col") + 0.5) * width - 180
    shift = 2 * (level - above)
    return cells.select(
        "*",
        F.shiftright("cell_row", shift).alias("parent_row"),
        F.shiftright("cell_col", shift).alias("parent_col"),
        F.struct(*unit_vector(centre_lat, centre_lon)).alias("centre"),
        # Along the centre's parallel, then along a meridian: never short.
        (F.radians(F.lit(width / 2)) * (1 + F.cos(F.radians(centre_lat)))).alias("radius"),
    )


def _apart() -> Column:
    """Straight line from the centre of a cell to a place."""
    sides = [F.col(f"centre.{axis}") - F.col(f"spot.{axis}") for axis in "xyz"]
    return F.sqrt(sum(side * side for side in sides))


def _thin_out(listed: DataFrame, points: DataFrame, level: int, above: int) -> DataFrame:
    """Short lists of one level from the lists of the level ``above``."""
    inside = ["parent_row", "parent_col"]

    def ready(cells: DataFrame, label: str) -> DataFrame:
        # Few by construction, or written, so that the planner knows their size.
        if level <= COARSE:
            return F.broadcast(_placed(cells, level, above))
        return _placed(settle(cells, label), level, above)

    # Pairs of cell and place exist only inside the two joins.
    closest = (
        listed.join(ready(_cells(points, level), "cells"), inside)
        .groupBy("cell_row", "cell_col", "cell_points")
        .agg(F.min(_apart()).alias("closest"))
    )
    return (
        listed.join(ready(closest, "closest"), inside)
        .where(_apart() <= F.col("closest") + 2 * F.col("radius") + SLACK)
        .select(
            "cell_row", "cell_col", "cell_points", "place_lat", "place_lon", "spot", "place"
        )
    )


def _compare(points: DataFrame, lists: DataFrame, level: int) -> DataFrame:
    """Each point with every place on the list of its cell."""
    return points.join(
        lists,
        (_row(level) == F.col("cell_row")) & (_col(level) == F.col("cell_col")),
    ).select(
        "latitude",
        "longitude",
        F.round(
            great_circle_km(
                F.col("latitude"),
                F.col("longitude"),
                F.col("place_lat"),
                F.col("place_lon"),
            ),
            6,
        ).alias("km"),
        "place",
    )


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    place_id: str = "place_id",
    carry: Sequence[str] = (),
    short_list: int = SHORT_LIST,
    cell_points: int = CELL_POINTS,
) -> DataFrame:
    """Distinct (latitude, longitude) of ``points`` with their nearest place.

    Adds ``place_id``, the ``carry`` columns of the place and ``km``. Of places
    equally near (to a millimetre) the lowest id wins. Coordinates that are
    NULL or off the globe get no row.
    """
    points = settle(
        _on_globe(points.select("latitude", "longitude"))
        .distinct()
        .select(
            "*",
            _index(F.col("latitude"), 90, 2).alias("deep_row"),
            _index(F.col("longitude"), 180, 4).alias("deep_col"),
        ),
        "points",
    )
    # Of several places at one coordinate only the lowest id can win.
    places = settle(
        _on_globe(places)
        .groupBy(
            F.col("latitude").alias("place_lat"), F.col("longitude").alias("place_lon")
        )
        .agg(F.min(F.struct(place_id, *carry)).alias("place"))
        .withColumn(
            "spot", F.struct(*unit_vector(F.col("place_lat"), F.col("place_lon")))
        ),
        "places",
    )
    # Level 0 cannot tell places apart: all are on the list of each of its eight
    # cells that holds a point.
    occupied = points.select(_row(0).alias("row"), _col(0).alias("col")).distinct().collect()
    roots = F.array(
        *[F.struct(F.lit(cell["row"]), F.lit(cell["col"])) for cell in occupied]
    ).cast("array<struct<row:int,col:int>>")
    open_lists = places.select(
        F.inline(roots).alias("parent_row", "parent_col"), *places.columns
    )
    open_points, compared = points, []
    above, level = 0, _first_level(points, places)
    while True:
        lists = settle(_thin_out(open_lists, open_points, level, above), "lists")
        if level == DEEPEST:
            compared.append(_compare(open_points, lists, level))
            break
        crowded = settle(
            lists.groupBy("cell_row", "cell_col", "cell_points")
            .agg(F.count("*").alias("listed"))
            .where(
                (F.col("listed") > short_list)
                | (F.col("cell_points") > cell_points)  # no task joins more points
            )
            .select("cell_row", "cell_col"),
            "crowded",
        )
        finished = lists.join(crowded, ["cell_row", "cell_col"], "left_anti")
        compared.append(_compare(open_points, finished, level))
        if crowded.isEmpty():
            break
        in_crowded = (_row(level) == F.col("cell_row")) & (_col(level) == F.col("cell_col"))
        # Written: the next level and its comparison read only what is left.
        open_points = settle(open_points.join(crowded, in_crowded, "left_semi"), "points")
        open_lists = lists.join(crowded, ["cell_row", "cell_col"], "left_semi").select(
            F.col("cell_row").alias("parent_row"),
            F.col("cell_col").alias("parent_col"),
            *places.columns,
        )
        above, level = level, level + 1
    # Compares the distance first, then the place, of which the id comes first.
    best = F.min(F.struct("km", "place")).alias("best")
    return (
        reduce(DataFrame.unionByName, compared)
        .groupBy("latitude", "longitude")
        .agg(best)
        .select(
            "latitude",
            "longitude",
            *[F.col("best.place")[name].alias(name) for name in (place_id, *carry)],
            "best.km",
        )
    )
