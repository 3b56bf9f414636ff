"""Square tiles for a search within a radius, cut into quarters where they are crowded.

Tiles start at 16 radii, so most search circles touch one of them only.  A tile
in which more pairs would be measured than a task should do is cut into four,
again and again, down to a quarter of the radius.  A crowded place is thus
divided by space: a search circle goes to the parts that it touches, and the
country around keeps its large tiles.  What is left over at the last level (very
many rows at almost one place) is divided by a hash of the rows.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from placetally.operators.skew import PARTS, split_join
from placetally.session import materialized

BASE_RADII = 16.0
LEVELS = 7
# A tile is cut from this share of all rows on, if that is more than the rows
# that follow from a task's pairs.  Tiles of a level do not overlap, so the list
# has at most 100,000 of each level, whatever the input; this is why it may be
# broadcast.
LEAST_SHARE = 1e-5
# Slack for rounding where a circle just touches a tile.
TOUCH_SLACK_M = 1e-3
# Helper columns; they do not reach the result of a join.
LEVEL, TX, TY = NODE = ("_level", "_tx", "_ty")
FINE_X, FINE_Y = "_fine_x", "_fine_y"
LOW_X, HIGH_X, LOW_Y, HIGH_Y = BOUNDS = ("_low_x", "_high_x", "_low_y", "_high_y")


def side_m(radius_m: float, level: int) -> float:
    return BASE_RADII * radius_m / (1 << level)


def _fine(coordinate: str, radius_m: float) -> str:
    return f"nvl(floor(({coordinate}) / {side_m(radius_m, LEVELS - 1)!r}D), 0L)"


def _ancestor(index: str, level: int | str) -> str:
    """Place of a tile of ``level`` along an axis, from that of a tile of the last level: halving is exact."""
    return f"shiftright({index}, {LEVELS - 1} - {level})"


def _touched(radius_m: float, level: int, parent: bool) -> str:
    """The tiles of a level that the circle around ``(x, y)`` touches; with ``parent`` those of the tile at hand only."""
    side = f"{side_m(radius_m, level)!r}D"
    spans = []
    for low, high, tile in ((LOW_X, HIGH_X, TX), (LOW_Y, HIGH_Y, TY)):
        first, last = _ancestor(low, level), _ancestor(high, level)
        if parent:
            first, last = f"greatest({first}, 2 * {tile})", f"least({last}, 2 * {tile} + 1)"
        spans.append(f"sequence({first}, {last})")
    node = f"named_struct('{LEVEL}', {level}, '{TX}', a, '{TY}', b)"
    apart = ", ".join(
        f"greatest(t.{tile} * {side} - {axis}, {axis} - (t.{tile} + 1) * {side}, 0D)" for tile, axis in ((TX, "x"), (TY, "y"))
    )
    nodes = f"flatten(transform({spans[0]}, a -> transform({spans[1]}, b -> {node})))"
    return f"filter({nodes}, t -> hypot({apart}) <= {float(radius_m + TOUCH_SLACK_M)!r}D)"


@dataclass(frozen=True)
class Quadtree:
    """The crowded tiles of ``others``, by the columns ``on``: those to cut, and those of the last level with their parts.

    ``nodes`` is stored and bounded (``LEAST_SHARE``), ``depth`` the number of
    levels that are cut somewhere, ``split`` whether the last one has crowded tiles.
    """

    radius_m: float
    on: tuple[str, ...]
    nodes: DataFrame
    depth: int
    split: bool

    @classmethod
    def of(
        cls, placed: DataFrame, radius_m: float, on: Sequence[str], rows_per_task: int, spots_per_tile: float
    ) -> "Quadtree":
        """Count ``placed`` rows (from ``with_fine``) by tile of every level; a Spark job runs at once.

        ``spots_per_tile`` is the number of circles that can start in a square
        of four radii; with it the rows of a tile tell its pairs.
        """
        counted = placed.groupBy(*on, FINE_X, FINE_Y).agg(F.count(F.lit(1)).alias("n"))
        levels = counted.withColumn(LEVEL, F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
        summed = (
            levels.withColumns({TX: F.expr(_ancestor(FINE_X, LEVEL)), TY: F.expr(_ancestor(FINE_Y, LEVEL))})
            .groupBy(*on, *NODE)
            .agg(F.sum("n").alias("n"))
        )
        # circles that reach a tile start in the square that is two radii wider
        reaching = F.lit(max(1.0, spots_per_tile)) * F.greatest(
            F.lit(1.0), F.pow(F.lit(BASE_RADII) / F.pow(F.lit(2.0), LEVEL) / 4 + 0.5, F.lit(2.0))
        )
        weighed = summed.withColumn("pairs", F.col("n") * reaching)
        crowded = F.col("pairs") > rows_per_task
        watch = Observation()
        stored = materialized(
            weighed.observe(
                watch, F.coalesce(F.sum(F.when(F.col(LEVEL) == 0, F.col("n"))), F.lit(0)).alias("rows"),
                F.count(F.when(crowded, 1)).alias("crowded"),
            ).filter(crowded),
            "crowded",
        )
        seen = watch.get
        if not seen["crowded"]:
            return cls(radius_m, tuple(on), stored, 0, False)
        nodes = stored.filter(F.col("n") > F.lit(seen["rows"] * LEAST_SHARE)).withColumn(
            PARTS, F.ceil(F.col("pairs") / F.lit(rows_per_task)).cast("int")
        )
        last = F.col(LEVEL) == LEVELS - 1
        found = nodes.agg(F.max(F.when(~last, F.col(LEVEL))).alias("deepest"), F.count(F.when(last, 1)).alias("last")).first()
        depth = 0 if found["deepest"] is None else found["deepest"] + 1
        return cls(radius_m, tuple(on), nodes.drop("n", "pairs"), depth, found["last"] > 0)

    def _with_cut(self, df: DataFrame, level: int) -> DataFrame:
        cut = self.nodes.filter(F.col(LEVEL) == level).select(*self.on, *NODE, F.lit(True).alias("_cut"))
        return df.join(F.broadcast(cut), [*self.on, *NODE], "left")

    def others(self, placed: DataFrame) -> DataFrame:
        """Each row with the one tile it lies in."""
        df = placed.withColumns(
            {LEVEL: F.lit(0), TX: F.expr(_ancestor(FINE_X, 0)), TY: F.expr(_ancestor(FINE_Y, 0))}
        )
        for level in range(self.depth):
            df = self._with_cut(df, level).withColumns({
                LEVEL: F.expr(f"if(_cut, {level + 1}, {LEVEL})"),
                TX: F.expr(f"if(_cut, {_ancestor(FINE_X, level + 1)}, {TX})"),
                TY: F.expr(f"if(_cut, {_ancestor(FINE_Y, level + 1)}, {TY})"),
            }).drop("_cut")
        return df.drop(FINE_X, FINE_Y)

    def spots(self, spots: DataFrame) -> DataFrame:
        """A row for each spot (``x, y``) and tile that its circle touches."""
        reach = f"{float(self.radius_m + TOUCH_SLACK_M)!r}D"
        bounds = zip(BOUNDS, (f"x - {reach}", f"x + {reach}", f"y - {reach}", f"y + {reach}"))
        rest = [*spots.columns, *BOUNDS]
        df = spots.withColumns({name: F.expr(_fine(edge, self.radius_m)) for name, edge in bounds})
        df = df.select(*rest, F.expr(f"inline({_touched(self.radius_m, 0, parent=False)})"))
        for level in range(self.depth):
            same = f"array(named_struct('{LEVEL}', {LEVEL}, '{TX}', {TX}, '{TY}', {TY}))"
            parts = f"if(_cut, {_touched(self.radius_m, level + 1, parent=True)}, {same})"
            df = self._with_cut(df, level).withColumn("_parts", F.expr(parts)).select(*rest, F.expr("inline(_parts)"))
        return df.drop(*BOUNDS)

    def joined(self, placed: DataFrame, spots: DataFrame, spread_by: Sequence[str]) -> DataFrame:
        """Pairs of a spot and a row that share a tile, each once."""
        keys = [*self.on, *NODE]
        left, right = self.others(placed), self.spots(spots)
        if not self.split:
            return left.join(right, keys).drop(*NODE)
        hot = self.nodes.filter(F.col(LEVEL) == LEVELS - 1).select(*keys, PARTS)
        return split_join(left, right, keys, spread_by, hot=hot).drop(*NODE)


def with_fine(df: DataFrame, x: str, y: str, radius_m: float) -> DataFrame:
    """Add the tile of the last level that a row lies in."""
    return df.withColumns({FINE_X: F.expr(_fine(x, radius_m)), FINE_Y: F.expr(_fine(y, radius_m))})
