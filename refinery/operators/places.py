"""Nearest places through cells that follow their density.

Unit vectors fall into nested cubes: each level's cubes have a quarter of the
side of those above, so a cube has about 24 children where the sphere passes.
A cube with more than ``LEAF`` places is split, down to ``FINEST`` (sides of
about 200 m); a cube's row holds the number and the bounding box of its
places.  Cubes have no poles and no date line.

A search goes down from the level whose cubes are as wide as the radius: a
point meets at most the 27 cubes around it there.  At each level the open
cubes are replaced by their children (an equi-join on the parent cube); the
farthest corner of a box bounds the nearest place's distance from above, its
nearest corner from below, and a cube whose lower bound exceeds the least
upper bound is dropped.  Points go down together: those of one cube of level
``ASK`` (800 m) are one asker, a box of points, whose bounds hold for each of
them; its places, if that cube has some, bound the distance from the start.
So an asker keeps the few leaves that can hold a nearest place, however the
places are spread; each of its points drops those beyond its own bound and
compares the places of the others: the pairs per point do not grow with the
places.

Plan on Spark: one lazy plan, per level one join and one aggregate by asker.
A point itself moves three times, as a short row: to its asker's leaves, from
there to each leaf's places (one row of at most ``2 * LEAF`` places; a fuller
leaf of the last level is several rows), and with the nearest of them to the
least.  A place moves once per level to find its leaf.  The cubes of the upper
levels are few rows, which AQE measures and broadcasts; those of a hot region
are shared by many points, and the rebalance over them lets AQE split the
points (:func:`refinery.sources.tables.keyed_side`).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.geo import EARTH_RADIUS_KM, haversine_km
from refinery.sources.tables import keyed_side

# Places in a cube that is not split; levels shrink by FACTOR; the last level;
# the level whose cubes gather points.
LEAF, FACTOR, FINEST, ASK = 64, 4, 8, 7
# More than the rounding of distances, on the unit sphere.
CLOSE = 1e-9
AXES = "xyz"
BOX = [f"{n}{a}" for a in AXES for n in ("lo", "hi")]


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    phi, lmb = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lmb), F.cos(phi) * F.sin(lmb), F.sin(phi)


def _side(level: int) -> float:
    return 2.0 / FACTOR**level


def _cell(value: Column, level: int) -> Column:
    return F.floor((value + F.lit(1.0)) / F.lit(_side(level))).cast("long")


def _id(cells: list[Column], level: int) -> Column:
    """One number per cube of all levels; a cell is below 2^17."""
    return reduce(lambda n, c: n * F.lit(1 << 17) + c, cells, F.lit(level).cast("long"))


def _cube_of(v: dict[str, Column], level: int) -> Column:
    return _id([_cell(v[a], level) for a in AXES], level)


def _gap2(q: dict[str, Column], box: dict[str, Column], far: bool) -> Column:
    """Squared distance between the nearest or farthest points of two boxes,
    columns or fields ``lox hix ...``."""
    total = F.lit(0.0)
    for a in AXES:
        ends = q[f"hi{a}"] - box[f"lo{a}"], box[f"hi{a}"] - q[f"lo{a}"]
        gap = F.greatest(*ends) if far else F.greatest(-ends[0], -ends[1], F.lit(0.0))
        total = total + gap * gap
    return total


def _fields(c: Column) -> dict[str, Column]:
    return {b: c[b] for b in BOX}


def _slack(c: Column) -> Column:
    return F.sqrt(c) + F.lit(CLOSE)


def distinct_places(places: DataFrame) -> DataFrame:
    """One place per coordinate (the smallest ``place_id``) with its unit vector."""
    found = places.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    one = found.groupBy(F.col("latitude").alias("p_lat"), F.col("longitude").alias("p_lon")).agg(
        F.min(F.struct("place_id", "county", "state")).alias("p"))
    return one.select("p_lat", "p_lon", "p", *[v.alias(f"p_{a}") for a, v in zip(AXES, unit_vector(F.col("p_lat"), F.col("p_lon")))])


def _box_of(prefix: str) -> Column:
    return F.struct(*[f(f"{prefix}{a}").alias(f"{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))])


def cubes(placed: DataFrame, level: int) -> DataFrame:
    """The cubes of a level: ``id``, their parent's ``up``, ``leaf``, the
    number ``n`` of their places and the ``box`` around these."""
    cells = [_cell(F.col(f"p_{a}"), level).alias(f"c{a}") for a in AXES]
    found = placed.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"), *[
        f(f"p_{a}").alias(f"{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))])
    own = [F.col(f"c{a}") for a in AXES]
    return found.select(
        _id(own, level).alias("id"), _id([F.floor(c / FACTOR).cast("long") for c in own], level - 1).alias("up"),
        (F.lit(True) if level == FINEST else F.col("n") <= LEAF).alias("leaf"), "n", F.struct(*BOX).alias("box"))


def _top_level(chord: float) -> int:
    """The finest level whose cubes are as wide as the chord."""
    level = 0
    while level < FINEST and _side(level + 1) >= chord:
        level += 1
    return level


def chord_of(radius_km: float) -> float:
    return 2.0 * math.sin(min(radius_km / (2.0 * EARTH_RADIUS_KM), math.pi / 2)) * (1.0 + 1e-9)


def leaf_places(placed: DataFrame, top: int) -> DataFrame:
    """The places of each leaf, and of the cubes below it: ``id, places``, in
    one row, or in several if a leaf of the last level holds more than
    ``2 * LEAF``."""
    leaves = reduce(DataFrame.unionByName, [cubes(placed, i).where("leaf").select("id", "n") for i in range(top, FINEST + 1)])
    v = {a: F.col(f"p_{a}") for a in AXES}
    at = placed.select(F.struct("*").alias("place"), F.explode(F.array(*[_cube_of(v, i) for i in range(top, FINEST + 1)])).alias("id"))
    part = F.when(F.col("n") > 2 * LEAF, F.pmod(F.xxhash64("place.p_lat", "place.p_lon"), F.ceil(F.col("n") / LEAF))).otherwise(F.lit(0))
    return at.join(keyed_side(leaves), "id").groupBy("id", part.alias("part")).agg(F.collect_list("place").alias("places")).drop("part")


def reached_leaves(asks: DataFrame, placed: DataFrame, top: int, chord: float) -> DataFrame:
    """Per asker (``ask``, the box ``me`` of its points, the box ``own`` of
    the places in its cube) the leaves that can hold a nearest place of one of
    its points: ``done``, an array of ``id, leaf, near, box``."""
    me = _fields(F.col("me"))
    node = F.struct("id", "leaf", F.col("__near").alias("near"), "box")
    kind = f"array<struct<id:bigint,leaf:boolean,near:double,box:struct<{','.join(f'{b}:double' for b in BOX)}>>>"
    keys = ["ask", "me", "own"]

    def settled(met: DataFrame) -> DataFrame:
        """Per asker the bound, and its leaves and open cubes within it."""
        found = met.withColumns({"__near": _gap2(me, _fields(F.col("box")), far=False), "__far": _gap2(me, _fields(F.col("box")), far=True)})
        possible = F.sqrt(F.col("__near")) <= _slack(F.col("bound"))
        state = found.groupBy(*keys).agg(
            F.min(F.least("bound", F.coalesce("__far", "bound"))).alias("bound"), F.first("done", ignorenulls=True).alias("done"),
            F.collect_list(F.when(F.col("leaf").isNotNull() & possible, node)).alias("kids"))
        here = lambda n: F.sqrt(n["near"]) <= _slack(F.col("bound"))
        return state.select(*keys, "bound",
                            F.filter(F.concat(F.coalesce("done", F.array().cast(kind)), F.filter("kids", lambda n: n["leaf"])), here).alias("done"),
                            F.filter("kids", lambda n: ~n["leaf"] & here(n)).alias("open"))

    side = F.lit(_side(top))
    steps = [(dx, dy, dz) for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1)]
    around = F.array(*[F.struct(*[(_cell(me[f"lo{a}"], top) + d).alias(f"c{a}") for a, d in zip(AXES, step)]) for step in steps])

    def in_reach(c: Column) -> Column:
        low = {a: c[f"c{a}"] * side - F.lit(1.0) for a in AXES}
        cube = {f"lo{a}": low[a] for a in AXES} | {f"hi{a}": low[a] + side for a in AXES}
        return F.sqrt(_gap2(me, cube, far=False)) <= F.lit(chord + CLOSE)

    asked = asks.select(*keys, "bound", F.lit(None).cast(kind).alias("done"), F.explode(F.filter(around, in_reach)).alias("__c"))
    asked = asked.withColumn("id", _id([F.col(f"__c.c{a}") for a in AXES], top)).drop("__c")
    state = settled(asked.join(keyed_side(cubes(placed, top).select("id", "leaf", "box")), "id"))

    for level in range(top + 1, FINEST + 1):
        # An asker without an open cube keeps one row, in a cube that no place is in (spread, so that they do not meet).
        nowhere = F.lit(-1) - F.pmod(F.xxhash64("ask"), F.lit(1 << 20))
        opened = state.select(*keys, "bound", "done", F.posexplode_outer("open").alias("__i", "__o"))
        opened = opened.select(*keys, "bound", F.when(F.coalesce("__i", F.lit(0)) == 0, F.col("done")).alias("done"),
                               F.coalesce("__o.id", nowhere).alias("up"))
        state = settled(opened.join(keyed_side(cubes(placed, level).select("id", "up", "leaf", "box")), "up", "left"))
    return state.select("ask", "own", "done")


def candidate_pairs(points: DataFrame, placed: DataFrame, radius_km: float, latitude: str, longitude: str) -> DataFrame:
    """(point, place) pairs among which each point's nearest place within the
    radius is: ``q_lat q_lon`` and the columns of ``placed``.  Of each leaf
    that a point looks into, the nearest places are paired with it."""
    chord = chord_of(radius_km)
    top = _top_level(chord)
    level = max(top, ASK)
    lat, lon = F.col(latitude), F.col(longitude)
    bound = F.lit(chord * chord * (1.0 + 1e-9))
    pts = points.where(lat.isNotNull() & lon.isNotNull()).select(lat.alias("q_lat"), lon.alias("q_lon")).distinct()
    v = dict(zip(AXES, unit_vector(F.col("q_lat"), F.col("q_lon"))))
    q = {a: F.col(f"q_{a}") for a in AXES}
    at = {f"{n}{a}": q[a] for a in AXES for n in ("lo", "hi")}
    vectors = {f"q_{a}": v[a] for a in AXES}
    pts = pts.withColumns(vectors).withColumn("ask", _cube_of(q, level)).drop(*vectors)

    asks = pts.withColumns(vectors).groupBy("ask").agg(_box_of("q_").alias("me"))
    own = cubes(placed, level).select(F.col("id").alias("ask"), F.col("box").alias("own"))
    asks = asks.join(own, "ask", "left").withColumn(
        "bound", F.least(bound, _gap2(_fields(F.col("me")), _fields(F.col("own")), far=True)))
    known = keyed_side(reached_leaves(asks, placed, top, chord))

    looked = pts.join(known, "ask").withColumns(vectors)
    fars = F.transform("done", lambda n: _gap2(at, _fields(n["box"]), far=True))
    looked = looked.withColumn("bound", F.least(bound, _gap2(at, _fields(F.col("own")), far=True), F.array_min(fars)))
    near = F.filter("done", lambda n: F.sqrt(_gap2(at, _fields(n["box"]), far=False)) <= _slack(F.col("bound")))
    looked = looked.select("q_lat", "q_lon", "bound", F.explode(F.transform(near, lambda n: n["id"])).alias("id"))

    met = looked.join(keyed_side(leaf_places(placed, top)), "id").withColumns(vectors)

    def apart(p: Column) -> Column:
        gaps = [p[f"p_{a}"] - q[a] for a in AXES]
        return F.sqrt(gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2])

    # Columns read more than once are not folded into the loops over the places.
    met = met.withColumn("__d", F.transform("places", apart)).withColumn("__least", F.array_min("__d"))
    nearest = F.when(F.col("__least") <= _slack(F.col("bound")), F.col("__least") + F.lit(CLOSE))
    met = met.select("q_lat", "q_lon", "places", "__d", nearest.alias("__most"))
    return met.select("q_lat", "q_lon", F.inline(F.filter("places", lambda p, i: (F.get("__d", i) <= F.col("__most")) & F.col("__most").isNotNull())))


def nearest_place(points: DataFrame, places: DataFrame, *, radius_km: float = 100.0,
                  latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """Nearest place within ``radius_km`` of each distinct (latitude,
    longitude) in ``points``; points without one, and NULL coordinates, are
    left out.

    Of places with one coordinate the smallest ``place_id`` counts; distances
    are rounded to 1e-6 km before they are compared, so ties go to the
    smallest ``place_id``.
    """
    pairs = candidate_pairs(points, distinct_places(places), radius_km, latitude, longitude)
    distance = F.round(haversine_km(F.col("q_lat"), F.col("q_lon"), F.col("p_lat"), F.col("p_lon")), 6)
    best = F.struct(distance.alias("distance_km"), F.col("p.place_id").alias("place_id"), F.col("p.county").alias("county"), F.col("p.state").alias("state"))
    found = pairs.groupBy("q_lat", "q_lon").agg(F.min(best).alias("best"))
    return found.where(F.col("best.distance_km") <= radius_km).select(
        F.col("q_lat").alias(latitude), F.col("q_lon").alias(longitude), "best.place_id", "best.distance_km", "best.county", "best.state")
