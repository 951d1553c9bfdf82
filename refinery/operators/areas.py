"""The area (county, state) that contains a point.

An area is a polygon in longitude and latitude: rings of vertices under the
even-odd rule, so holes and separate parts need no mark and no orientation.
A ring may cross the date line: if two neighbouring vertices are more than 180
degrees apart, all of it is laid within 180 degrees of its first vertex.  Edges are straight in longitude and latitude; areas
around a pole have to be cut along a meridian.

Cover: an area is laid over square cells of its own level, whose side gives
it 4 to 16 cells each way (levels go in steps of two, so there are eleven).
Cells that an edge may touch are border cells and carry the edges of their
band of latitudes that are not left of them; of the others, those whose centre
is inside are inner cells.  A point looks for its cell on every level (an
equi-join); an inner cell settles it, a border cell asks for the ray test.

Ray test: an edge counts if its ends lie on different sides of the point's
latitude (one end included) and it meets that latitude right of the point.
The meeting place is computed from the lower end, so two areas get the same
number for a shared edge, and a point on it belongs to exactly one of them.

Plan on Spark: one lazy plan without Python; the cover grows with the areas,
a point makes one row per level and date-line copy.  AQE measures the cover
and broadcasts it or splits the points of a hot cell.  A border cell's list is
bounded by its area's edges in one band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = tuple(range(0, 21, 2))
TURN = 360.0


def _side(level: Column | int) -> Column:
    return F.lit(TURN) / F.pow(F.lit(2.0), level if isinstance(level, Column) else F.lit(level))


def _cell(value: Column, level: Column) -> Column:
    return F.floor((value + F.lit(TURN)) / _side(level)).cast("long")


def edges_of(areas: DataFrame) -> DataFrame:
    """``area_id`` and each edge, from its lower to its upper end: ``xa ya xb
    yb``.  A ring across the date line goes on past 180 or -180; level edges,
    which no ray test counts, stay for the cover."""
    def turned(ring: Column) -> Column:
        return F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    rings = areas.select("area_id", F.explode("rings").alias("ring")).where(
        (F.size("ring") >= 3) & F.forall("ring", lambda v: v["lon"].isNotNull() & v["lat"].isNotNull()))
    crosses = F.exists(F.zip_with("ring", turned(F.col("ring")), lambda v, w: F.abs(v["lon"] - w["lon"])), lambda d: d > TURN / 2)
    first = F.element_at("ring", 1)["lon"]
    rings = rings.withColumns({"crosses": crosses, "first": first}).select("area_id", F.transform("ring", lambda v: F.struct(
        (v["lon"] + F.when(F.col("crosses"), F.round((F.col("first") - v["lon"]) / TURN) * TURN).otherwise(F.lit(0.0))).alias("x"),
        v["lat"].alias("y"))).alias("ring"))
    both = rings.select("area_id", F.explode(F.arrays_zip(F.col("ring").alias("v"), turned(F.col("ring")).alias("w"))).alias("e"))
    rises = F.struct("e.v.y", "e.v.x") <= F.struct("e.w.y", "e.w.x")
    both = both.select("area_id", F.when(rises, F.col("e.v")).otherwise(F.col("e.w")).alias("a"), F.when(rises, F.col("e.w")).otherwise(F.col("e.v")).alias("b"))
    return both.select("area_id", F.col("a.x").alias("xa"), F.col("a.y").alias("ya"), F.col("b.x").alias("xb"), F.col("b.y").alias("yb"))


def _meets(e, x: Column, y: Column) -> Column:
    """Whether the ray from (x, y) to the right counts the edge ``e``."""
    crosses = (e("ya") > y) != (e("yb") > y)
    return crosses & (x < e("xa") + (y - e("ya")) * (e("xb") - e("xa")) / (e("yb") - e("ya")))


def cover(areas: DataFrame) -> DataFrame:
    """``level cx cy``, ``area_id`` and ``edges`` (NULL: an inner cell) of the
    cells of every area."""
    edges = edges_of(areas)
    box = edges.groupBy("area_id").agg(F.min("xa").alias("x0a"), F.min("xb").alias("x0b"), F.max("xa").alias("x1a"), F.max("xb").alias("x1b"),
                                       F.min("ya").alias("y0"), F.max("yb").alias("y1"))
    x0, x1 = F.least("x0a", "x0b"), F.greatest("x1a", "x1b")
    extent = F.greatest(x1 - x0, F.col("y1") - F.col("y0"), F.lit(TURN * 16 / 2 ** LEVELS[-1]))
    level = F.least(F.lit(LEVELS[-1]), F.greatest(F.lit(0), 2 * F.floor(F.log2(F.lit(TURN * 16) / extent) / 2))).cast("int")
    box = box.select(F.col("area_id").alias("box_id"), level.alias("level"), x0.alias("x0"), x1.alias("x1"), "y0", "y1")
    lv = F.col("level")
    rows = F.sequence(_cell(F.col("y0"), lv), _cell(F.col("y1"), lv))
    columns = F.sequence(_cell(F.col("x0"), lv), _cell(F.col("x1"), lv))
    # A row of cells stays one row until it has met its band.
    lines = box.select(F.col("box_id").alias("area_id"), "level", F.explode(rows).alias("cy"), "x0", "x1")

    # Edges by band of latitudes, at most 17 each.
    e = lambda c: F.col(f"e.{c}")
    edge = F.struct("xa", "ya", "xb", "yb")
    band = edges.join(box, F.col("area_id") == F.col("box_id")).select(
        "area_id", "level", edge.alias("e"), F.explode(F.sequence(_cell(F.col("ya"), lv), _cell(F.col("yb"), lv))).alias("cy"))
    side = _side(lv)
    middle = (F.col("cy") + 0.5) * side - TURN
    meeting = e("xa") + (middle - e("ya")) * (e("xb") - e("xa")) / (e("yb") - e("ya"))
    bands = band.groupBy("area_id", "level", "cy").agg(
        F.collect_list("e").alias("all"),
        F.collect_list(F.when((e("ya") > middle) != (e("yb") > middle), meeting)).alias("cuts"))
    on = ["area_id", "level", "cy"]
    met = lines.join(bands, on, "left").select(*on, "all", "cuts", F.explode(columns).alias("cx"))
    left, right = F.col("cx") * side - TURN, (F.col("cx") + 1) * side - TURN
    # Cells are taken a little wider than they are, so that rounding never makes a border cell an inner one.
    slack = side * 1e-9
    reach = lambda n: (F.greatest(n["xa"], n["xb"]) >= left - slack)
    touches = lambda n: reach(n) & (F.least(n["xa"], n["xb"]) <= right + slack)
    centre = (F.col("cx") + 0.5) * side - TURN
    border = F.exists("all", touches)
    inside = F.size(F.filter("cuts", lambda x: centre < x)) % 2 == 1
    kept = met.select(*on, "cx", F.when(F.coalesce(border, F.lit(False)), F.filter("all", reach)).alias("edges"), F.coalesce(inside, F.lit(False)).alias("inside"))
    return kept.where(F.col("edges").isNotNull() | F.col("inside")).select("level", "cx", "cy", "area_id", "edges")


def containing_area(points: DataFrame, areas: DataFrame, *, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """The area of each distinct (latitude, longitude) in ``points`` (the
    smallest ``area_id`` of several): ``area_id``, ``county`` and ``state``.
    Points in no area, and those with a NULL or non-finite coordinate, are
    left out.  ``areas``: ``area_id, county, state`` and ``rings``, an array
    of rings, each an array of (lon, lat); a ring of fewer than three vertices
    holds nothing; an ``area_id`` stands for one row."""
    lat, lon = F.col(latitude).cast("double"), F.col(longitude).cast("double")
    fine = (F.abs(lat) <= 90.0) & (F.abs(lon) <= TURN)
    pts = points.where(fine).select(lat.alias("q_lat"), lon.alias("q_lon")).distinct()
    # A ring across the date line lies up to a turn further east or west.
    probes = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(t * TURN).alias("t")) for i in LEVELS for t in (-1, 0, 1)])
    asked = pts.select("q_lat", "q_lon", F.inline(probes))
    x = F.col("q_lon") + F.col("t")
    asked = asked.where((x >= -TURN) & (x < 2 * TURN)).select(
        "q_lat", "q_lon", "level", x.alias("x"), _cell(x, F.col("level")).alias("cx"), _cell(F.col("q_lat"), F.col("level")).alias("cy"))
    met = asked.join(cover(areas), ["level", "cx", "cy"])
    hits = F.size(F.filter("edges", lambda n: _meets(lambda c: n[c], F.col("x"), F.col("q_lat"))))
    within = met.where(F.col("edges").isNull() | (hits % 2 == 1))
    found = within.groupBy("q_lat", "q_lon").agg(F.min("area_id").alias("area_id"))
    named = areas.select("area_id", "county", "state")
    return found.join(named, "area_id").select(F.col("q_lat").alias(latitude), F.col("q_lon").alias(longitude), "area_id", "county", "state")
