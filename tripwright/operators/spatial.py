"""Point-in-box join for many points against many boxes.

A direct range predicate plans as a nested-loop join (every point against
every box).  Here both sides are mapped onto a multi-level square grid and
joined on (level, cell_x, cell_y), an equi-join Spark can hash or sort-merge
and AQE can split when one cell is hot; the exact inclusive box test then
refines the candidates.

Each box picks the smallest level whose cell is at least as wide as the
box's larger side - below the given cell size for small boxes, down to a
finest level for boxes without extent - so it touches at most 2 x 2 cells at
that level; every covered cell is emitted, so no candidate is ever dropped and
no box is capped.  Each point emits one cell per level in use.  A (point, box)
pair can meet in exactly one cell: the point's cell at the box's level.

A cell that a sample shows to hold many points is split like a quadtree: into so
many levels of quarters that one holds about ``SPLIT_POINTS``.  Its points go to
their quarter and its boxes to the quarters they touch, so a city that nine tenths
of all trips start in is shared by many tasks, and a small box there meets the
points near it only.

A box with a NULL or NaN corner, or whose corners are swapped, holds no point.
Infinite corners are clamped for the choice of cells only; the exact test uses
the box as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.geo import box_contains
from ..session import ensure_checkpoint_dir


FINEST = -30     # level of boxes without extent: cells of cell / 2**30
COARSEST = 50    # clamp: coordinates beyond cell * 2**49 share the outermost cells


def _level_of(span, cell: float):
    return F.greatest(F.lit(FINEST), F.when(span > 0, F.ceil(F.log2(span / F.lit(float(cell))))).otherwise(
        F.lit(FINEST))).cast("int")


def _cell_size(level, cell: float):
    return F.lit(float(cell)) * F.pow(F.lit(2.0), level.cast("double"))


def _clamped(c, cell: float):
    edge = float(cell) * 2.0 ** (COARSEST - 1)
    return F.least(F.greatest(c, F.lit(-edge)), F.lit(edge))


def box_cells(boxes: DataFrame, box_col: str = "box_coord", cell: float = 1.0) -> DataFrame:
    """Boxes exploded to the grid cells they cover at their own level."""
    b = F.col(box_col)
    corners = [b[c] for c in ("x0", "y0", "x1", "y1")]
    valid = (b["x0"] <= b["x1"]) & (b["y0"] <= b["y1"])
    for c in corners:
        valid &= c.isNotNull() & ~F.isnan(c)
    x0, y0, x1, y1 = (_clamped(c, cell) for c in corners)
    lv = boxes.where(valid).withColumn("_lvl", _level_of(F.greatest(x1 - x0, y1 - y0), cell))
    size = _cell_size(F.col("_lvl"), cell)
    return (lv.withColumn("_cx", F.explode(F.sequence(F.floor(x0 / size), F.floor(x1 / size))))
              .withColumn("_cy", F.explode(F.sequence(F.floor(y0 / size), F.floor(y1 / size)))))


def point_cells(points: DataFrame, levels: list[int], x: str = "x", y: str = "y",
                cell: float = 1.0) -> DataFrame:
    """Points with one grid cell per level in ``levels``."""
    px, py = F.col(x), F.col(y)
    lv = points.where(px.isNotNull() & py.isNotNull() & ~F.isnan(px) & ~F.isnan(py))
    lv = lv.withColumn("_lvl", F.explode(F.array(*[F.lit(int(v)) for v in levels])))
    size = _cell_size(F.col("_lvl"), cell)
    return (lv.withColumn("_cx", F.floor(_clamped(px, cell) / size))
              .withColumn("_cy", F.floor(_clamped(py, cell) / size)))


SPLIT_POINTS = 1_000_000     # points of a cell from which it is split
SAMPLE = 0.01                # of the points, to count them by cell
MOST_SPLITS = 8              # levels of quarters; a cell of equal points can't be split by place
MAX_BROADCAST_CELLS = 100_000


def crowded_cells(cells: DataFrame, keys: list[str], most: int = SPLIT_POINTS, sample: float = SAMPLE) -> DataFrame:
    """``keys`` and ``_depth``, the levels to split it by, of the cells with more
    than ``most`` points by a sample's count.  What it says changes where pairs
    meet and not which."""
    n = F.count("*") / F.lit(sample)
    depth = F.least(F.ceil(F.log(4.0, n / F.lit(float(most)))), F.lit(MOST_SPLITS)).cast("int")
    found = cells.sample(fraction=sample, seed=1) if sample < 1 else cells
    return found.groupBy(*keys).agg(depth.alias("_depth")).where(F.col("_depth") > 0)


def _quarters(pc: DataFrame, bc: DataFrame, crowded: DataFrame, keys: list[str], x: str, y: str, box_col: str,
              cell: float) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_qx`` and ``_qy``: the quarter inside a split cell, 0 in
    others."""
    depth = F.coalesce("_depth", F.lit(0))
    size = _cell_size(F.col("_lvl"), cell)
    parts = F.pow(F.lit(2.0), depth)

    def quarter(c, at):
        """Of a coordinate inside the cell or beyond it, the number from 0."""
        inside = F.floor((c - F.col(at) * size) / (size / parts))
        return F.greatest(F.least(inside, parts - 1), F.lit(0)).cast("int")
    b = F.col(box_col)
    x0, y0, x1, y1 = (_clamped(b[c], cell) for c in ("x0", "y0", "x1", "y1"))
    pc = pc.join(crowded, keys, "left")
    bc = bc.join(crowded, keys, "left")
    return (pc.withColumn("_qx", quarter(_clamped(F.col(x), cell), "_cx"))
              .withColumn("_qy", quarter(_clamped(F.col(y), cell), "_cy")).drop("_depth"),
            bc.withColumn("_qx", F.explode(F.sequence(quarter(x0, "_cx"), quarter(x1, "_cx"))))
              .withColumn("_qy", F.explode(F.sequence(quarter(y0, "_cy"), quarter(y1, "_cy")))).drop("_depth"))


def points_in_boxes(points: DataFrame, boxes: DataFrame, x: str = "x", y: str = "y",
                    box_col: str = "box_coord", cell: float = 1.0, on: list[str] | None = None,
                    split_points: int = SPLIT_POINTS, sample: float = SAMPLE) -> DataFrame:
    """All (point, box) pairs with the point inside the box, edges inclusive.

    Output: every column of ``points`` and of ``boxes``; names must not clash
    but for those in ``on``, which must be equal too and join with the cell.
    ``cell`` is the grid cell side of level 0, in coordinate units.  The levels
    in use are integers from FINEST to COARSEST + 1, so the short list is
    brought to the driver to build the point expansion.
    """
    on = on or []
    # The box side is read twice (levels, then the join): pin it once with a
    # reliable checkpoint so an aggregate feeding it is not recomputed.
    ensure_checkpoint_dir(boxes.sparkSession)
    bc = box_cells(boxes, box_col, cell).checkpoint(eager=True)
    levels = sorted(r[0] for r in bc.select("_lvl").distinct().collect())
    if not levels:
        # No valid box: the answer is empty, with the joined columns.
        spark = points.sparkSession
        schema = StructType(points.schema.fields + [f for f in boxes.schema.fields if f.name not in on])
        return spark.createDataFrame([], schema)
    pc = point_cells(points, levels, x, y, cell)
    keys = [*on, "_lvl", "_cx", "_cy"]
    crowded = crowded_cells(pc, keys, split_points, sample).join(bc.select(*keys), keys, "left_semi")
    crowded = crowded.checkpoint(eager=True)           # both sides use it
    if not crowded.isEmpty():
        if crowded.limit(MAX_BROADCAST_CELLS + 1).count() <= MAX_BROADCAST_CELLS:
            crowded = F.broadcast(crowded)
        pc, bc = _quarters(pc, bc, crowded, keys, x, y, box_col, cell)
        keys += ["_qx", "_qy"]
    joined = pc.join(bc, keys, "inner")
    hit = joined.where(box_contains(F.col(box_col), F.col(x), F.col(y)))
    return hit.drop("_lvl", "_cx", "_cy", "_qx", "_qy")
