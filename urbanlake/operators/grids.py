"""Grids, tiles and polygons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

TILE = 256


def _cells(df: DataFrame, nx, ny) -> DataFrame:
    span = lambda n: F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int")))
    return df.withColumn("i", F.explode(span(nx))).withColumn("j", F.explode(span(ny)))


def subdivide_4x4(df: DataFrame, edge: float, centered: bool = True) -> DataFrame:
    """Cells (x, y) of an edge in kilometres to 16 sub-centers; otherwise they start at the center, going north-east."""
    sx, sy = geo.LNG_KM * edge / 4, geo.LAT_KM * edge / 4
    start = -1.5 if centered else 0.0
    out = _cells(df, F.lit(4), F.lit(4))
    return out.withColumns({"sub_x": F.col("x") + (F.col("i") + start) * sx, "sub_y": F.col("y") + (F.col("j") + start) * sy, "span_x": F.lit(1.2 * sx), "span_y": F.lit(1.2 * sy)})


def subdivide_step(df: DataFrame, step: float = 0.001) -> DataFrame:
    """Boxes to cells of a step; how many is truncated."""
    n = lambda a, b: F.floor(F.round((F.col(a) - F.col(b)) / step, 6))
    out = _cells(df, n("lng_max", "lng_min"), n("lat_max", "lat_min"))
    return out.withColumns({"x": F.col("lng_min") + F.col("i") * step, "y": F.col("lat_min") + F.col("j") * step})


def adaptive_plan(df: DataFrame, totals, cap: int = 400, edge: float = 2.0, step: float = 0.001) -> DataFrame:
    """Centers (x, y) split while their total reaches the cap: into 16, then into cells of a step, then accepted.

    ``totals`` maps a DataFrame with x, y to the same with a total column. The box of a sub-center, 1.2 times its
    span at three decimals, is cut by the step. Returns all accepted centers with their round and whether they are
    still over the cap (only those of the third round are).
    """
    over = F.col("total") >= cap
    first = totals(df.select("x", "y"))
    sub = subdivide_4x4(first.filter(over), edge)
    sub = totals(sub.select(F.col("sub_x").alias("x"), F.col("sub_y").alias("y"), "span_x", "span_y"))
    side = lambda c, span, sign: F.round(F.col(c) + sign * F.col(span) / 2, 3)
    box = sub.filter(over).select(side("x", "span_x", -1).alias("lng_min"), side("x", "span_x", 1).alias("lng_max"), side("y", "span_y", -1).alias("lat_min"), side("y", "span_y", 1).alias("lat_max"))
    last = totals(subdivide_step(box, step).select("x", "y"))
    done = [known.filter(~over | F.lit(k == 3)).select("x", "y", F.lit(k).alias("round"), over.alias("over")) for k, known in ((1, first), (2, sub), (3, last))]
    return done[0].unionByName(done[1]).unionByName(done[2])


def escalate_lists(lists: DataFrame, children: Sequence[DataFrame], cap: int = 99) -> DataFrame:
    """(list, pages, level, over): lists over the cap are replaced by those of the next level (district, sub-area, bedrooms).

    ``lists`` has list, pages; each of ``children`` parent, list, pages. What is over the cap at the last level stays.
    """
    over, out, todo = F.col("pages") > cap, None, lists.select("list", "pages")
    for level in range(len(children) + 1):
        last = level == len(children)
        done = todo.filter(~over | F.lit(last)).select("list", "pages", F.lit(level).alias("level"), over.alias("over"))
        out = done if out is None else out.unionByName(done)
        if not last:
            todo = children[level].join(todo.filter(over).select(F.col("list").alias("parent")), "parent").select("list", "pages")
    return out


def make_grid(extent: DataFrame, origin: Sequence[int], step: Sequence[int]) -> DataFrame:
    """Cells (x0, y0, x1, y1) in micro-degrees over (x_min, y_min, x_max, y_max), aligned to the origin, a step of margin around."""
    cut = lambda c, o, s: ((F.col(c) - o) / s).cast("bigint")
    e = extent.select(F.explode(F.sequence(cut("x_min", origin[0], step[0]) - 1, cut("x_max", origin[0], step[0]) + 1)).alias("i"), "y_min", "y_max")
    e = e.select("i", F.explode(F.sequence(cut("y_min", origin[1], step[1]) - 1, cut("y_max", origin[1], step[1]) + 1)).alias("j"))
    x, y = F.lit(origin[0]) + F.col("i") * step[0], F.lit(origin[1]) + F.col("j") * step[1]
    return e.select(x.alias("x0"), y.alias("y0"), (x + step[0]).alias("x1"), (y + step[1]).alias("y1"))


def tiles_in_range(df: DataFrame) -> DataFrame:
    """All tiles between corners (x1, y1) and (x2, y2), in either order."""
    out = df.withColumn("x", F.explode(F.sequence(F.least("x1", "x2"), F.greatest("x1", "x2"))))
    return out.withColumn("y", F.explode(F.sequence(F.least("y1", "y2"), F.greatest("y1", "y2"))))


def calibrate_tiles(points: DataFrame) -> DataFrame:
    """From rows of two known points (ax, ay: tile; apx, apy: pixel; alng, alat; the same with b): degrees per
    pixel, and the corner of tile (0, 0)."""
    px = lambda p, t: F.col(f"{p}{t}") * TILE + F.col(f"{p}p{t}")
    dx = F.try_divide(F.col("blng") - F.col("alng"), px("b", "x") - px("a", "x"))
    dy = F.try_divide(F.col("blat") - F.col("alat"), px("b", "y") - px("a", "y"))
    return points.withColumns({"dx": dx, "dy": dy, "lng0": F.col("alng") - px("a", "x") * dx, "lat0": F.col("alat") - px("a", "y") * dy})


def calibrate_pairs(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``calibrate_tiles`` of every two neighbouring known points (keys, id, x, y: tile; px, py: pixel; lng, lat) in order of id.

    A point of a key is joined with the one after it, so a key of n points gives n - 1 calibrations.
    """
    after = F.lead(F.struct("id", "x", "y", "px", "py", "lng", "lat")).over(Window.partitionBy(*keys).orderBy("id"))
    pairs = points.withColumn("_b", after).filter("_b is not null")
    names = ("id", "x", "y", "px", "py", "lng", "lat")
    return calibrate_tiles(pairs.select(*keys, *(F.col(n).alias(f"a{n}") for n in names), *(F.col(f"_b.{n}").alias(f"b{n}") for n in names)))


def point_to_tile(lng: Column, lat: Column, dx: Column, dy: Column, lng0: Column, lat0: Column) -> Column:
    """struct(x, y, px, py): tile and pixel within it; y grows north."""
    gx, gy = F.floor((lng - lng0) / dx), F.floor((lat - lat0) / dy)
    return F.struct(F.floor(gx / TILE).alias("x"), F.floor(gy / TILE).alias("y"), F.pmod(gx, F.lit(TILE)).alias("px"), F.pmod(gy, F.lit(TILE)).alias("py"))


#: Degrees of a cell of level 0; a level halves them. Powers of two, so that keys are exact.
SPAN, DEEPEST = 512.0, 40


def _level(polygon: Column, refine: int) -> Column:
    """The finest level whose cells are as wide as a polygon's box, which so touches four of them at most."""
    width = F.greatest(*(F.array_max(polygon.getField(c)) - F.array_min(polygon.getField(c)) for c in ("lng", "lat")), F.lit(1e-9))
    return F.greatest(F.lit(0), F.least(F.floor(F.log2(F.lit(SPAN) / width)).cast("int"), F.lit(DEEPEST - refine)))


def cell_cover(polygons: DataFrame, refine: int = 5, tolerance: float = 2e-10, cell: float = 0.0) -> DataFrame:
    """(polygon_id, level, cx, cy, edges): cells that hold every point of a polygon; cells wholly inside have null edges.

    A polygon starts with the cells of its own size that its box touches. Cells that an edge touches are cut into
    four, ``refine`` times; those without an edge are inside or outside as a whole. So the number of cells depends on a
    polygon's shape, not on its extent: 4 ** (refine + 1) at most, and about a hundred for a simple one. Cells no wider
    than ``cell`` are not cut.
    """
    edges, side = F.col("edges"), lambda level: F.lit(SPAN) / F.pow(F.lit(2.0), level)

    def touched(level: Column, cx: Column, cy: Column) -> Column:
        """Whether an edge comes within the tolerance of a cell: boxes meet, and the corners aren't all on one side of it."""
        x0, x1 = cx * side(level) - tolerance, (cx + 1) * side(level) + tolerance
        y0, y1 = cy * side(level) - tolerance, (cy + 1) * side(level) + tolerance

        def meets(e: Column) -> Column:
            cross = [(e["qx"] - e["px"]) * (y - e["py"]) - (x - e["px"]) * (e["qy"] - e["py"]) for x in (x0, x1) for y in (y0, y1)]
            boxes = (F.least(e["px"], e["qx"]) <= x1) & (F.greatest(e["px"], e["qx"]) >= x0) & (F.least(e["py"], e["qy"]) <= y1) & (F.greatest(e["py"], e["qy"]) >= y0)
            return boxes & (F.least(*cross) <= tolerance) & (F.greatest(*cross) >= -tolerance)

        return F.exists(edges, meets)

    def placed(level: Column, cx: Column, cy: Column) -> Column:
        """kind: 2 at the border, 1 inside, 0 outside."""
        middle = geo.in_polygon((cx + 0.5) * side(level), (cy + 0.5) * side(level), edges, tolerance)
        return F.struct(level.cast("int").alias("level"), cx.cast("bigint").alias("cx"), cy.cast("bigint").alias("cy"), F.when(touched(level, cx, cy), 2).when(middle, 1).otherwise(0).alias("kind"))

    def span(c: str) -> Column:
        low, high = F.array_min(f"polygon.{c}") - tolerance, F.array_max(f"polygon.{c}") + tolerance
        return F.sequence(*(F.floor(v / side(F.col("level"))).cast("bigint") for v in (low, high)))

    rows = polygons.filter(F.size("polygon") >= 3).select("polygon_id", "polygon", geo.polygon_edges(F.col("polygon")).alias("edges"), _level(F.col("polygon"), refine).alias("level"))
    rows = rows.withColumns({"xs": span("lng"), "ys": span("lat")})
    rows = rows.select("polygon_id", "edges", F.flatten(F.transform("xs", lambda x: F.transform("ys", lambda y: placed(F.col("level"), x, y)))).alias("cells"))
    quarters = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))
    for _ in range(refine):
        cut = lambda c: F.transform(quarters, lambda q: placed(c["level"] + 1, c["cx"] * 2 + q["i"], c["cy"] * 2 + q["j"]))
        rows = rows.select("polygon_id", "edges", F.flatten(F.transform("cells", lambda c: F.when((c["kind"] == 2) & (side(c["level"]) > cell), cut(c)).otherwise(F.array(c)))).alias("cells"))
    found = rows.select("polygon_id", "edges", F.explode(F.filter("cells", lambda c: c["kind"] > 0)).alias("c"))
    return found.select("polygon_id", "c.level", "c.cx", "c.cy", F.when(F.col("c.kind") == 2, F.col("edges")).alias("edges"))


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float = 0.0, tolerance: float = 2e-10, refine: int = 5) -> DataFrame:
    """(point columns, polygon_id): the first polygon, by id, that holds each point; borders count as inside.

    Polygons are covered by cells of several levels (``cell_cover``) and a point is looked up once for each level in
    use, so it is an equi-join; rays are cast only in cells that a border touches. ``points`` has lng, lat and columns
    that identify a point (equal rows are one); ``polygons`` polygon_id, polygon array<struct(lng, lat)>, of three
    points at least.
    """
    starts = polygons.filter(F.size("polygon") >= 3).select(_level(F.col("polygon"), refine).alias("level")).distinct().collect()  # DEEPEST at most
    levels = sorted({r.level + k for r in starts for k in range(refine + 1)})
    key = lambda c: F.floor(F.col(c) / (F.lit(SPAN) / F.pow(F.lit(2.0), F.col("level")))).cast("bigint")
    near = points.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumns({"cx": key("lng"), "cy": key("lat")})
    near = near.join(cell_cover(polygons, refine, tolerance, cell), ["level", "cx", "cy"])
    hits = near.filter(F.col("edges").isNull() | geo.in_polygon(F.col("lng"), F.col("lat"), F.col("edges"), tolerance))
    return hits.groupBy(*points.columns).agg(F.min("polygon_id").alias("polygon_id"))


def count_in_cells(points: DataFrame, step: Sequence[int], levels: Sequence[float] = (), polygons: DataFrame | None = None) -> DataFrame:
    """Sum of ``count`` per cell of integer micro-degree points (x, y); a point on a border belongs to both cells.

    With ``polygons`` only cells with a corner in one. ``level`` is the number of thresholds that the sum exceeds.
    """

    def both(c: str, s: int) -> Column:
        i = F.floor(F.col(c) / s)
        return F.when(F.pmod(F.col(c), F.lit(s)) == 0, F.array(i - 1, i)).otherwise(F.array(i))

    rows = points.withColumn("i", F.explode(both("x", step[0]))).withColumn("j", F.explode(both("y", step[1])))
    out = rows.groupBy("i", "j").agg(F.sum("count").alias("total"))
    if polygons is not None:
        ends = F.array(*(F.struct((F.col("i") + a).alias("ci"), (F.col("j") + b).alias("cj")) for a in (0, 1) for b in (0, 1)))
        corners = out.select("i", "j", F.explode(ends).alias("c")).select("i", "j", "c.*")
        held = points_in_polygons(corners.select("ci", "cj").distinct().withColumns({"lng": F.col("ci") * step[0] / 1e6, "lat": F.col("cj") * step[1] / 1e6}), polygons)
        out = out.join(corners.join(held.select("ci", "cj"), ["ci", "cj"]).select("i", "j").distinct(), ["i", "j"], "left_semi")
    return out.withColumn("level", sum(((F.col("total") > t).cast("int") for t in levels), F.lit(0)))
