"""Date keys and geography, checked against brute force on small inputs."""

import datetime as dt
import math
import random
import re

from refinery.functions.geo import EARTH_RADIUS_KM
from refinery.operators.areas import containing_area, cover
from refinery.operators.enrich import DEFAULT_COUNTY, DEFAULT_STATE, add_datekeys, add_geography, nearest_place
from refinery.operators.places import candidate_pairs, distinct_places


def _hav(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    dp, dl = p2 - p1, math.radians(b[1]) - math.radians(a[1])
    h = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, h)))


def test_datekeys_null_stays_null(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 23, 59),), (None,)], "t timestamp")
    assert [r.t_datekey for r in add_datekeys(df, ["t"]).collect()] == [20240229, None]


def test_constant_geography(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, None)], "latitude double, longitude double")
    rows = add_geography(df).collect()
    assert {(r.county, r.state) for r in rows} == {(DEFAULT_COUNTY, DEFAULT_STATE)}


def test_nearest_place_matches_brute_force(spark):
    rng = random.Random(7)
    # places cluster near both poles, the date line and the equator
    places = []
    for i in range(400):
        lat = rng.choice([rng.uniform(80, 90), rng.uniform(-90, -80), rng.uniform(-10, 10)])
        lon = rng.choice([rng.uniform(170, 180), rng.uniform(-180, -170), rng.uniform(-180, 180)])
        places.append((i, round(lat, 2), round(lon, 2), f"c{i}", f"s{i % 7}"))
    places.append((1000, 90.0, 0.0, "north", "pole"))
    places.append((1001, 0.0, 180.0, "east", "line"))
    places.append((999, 0.0, -180.0, "west", "line"))  # the same point as 1001: tie → smaller id
    points = [(round(rng.uniform(-90, 90), 2), round(rng.uniform(-180, 180), 2)) for _ in range(300)]
    points += [(89.99, 123.0), (-89.99, -45.0), (0.0, 179.99), (0.0, -180.0), (0.0, 180.0)]
    pdf = spark.createDataFrame(places, "place_id long, latitude double, longitude double, county string, state string")
    qdf = spark.createDataFrame(points, "latitude double, longitude double")
    for radius in (50.0, 300.0, 2000.0):
        got = {(r.latitude, r.longitude): (r.place_id, r.distance_km)
               for r in nearest_place(qdf, pdf, radius_km=radius).collect()}
        want = {}
        for q in set(points):
            best = min(((round(_hav(q, p[1:3]), 6), p[0]) for p in places), default=None)
            if best and best[0] <= radius:
                want[q] = (best[1], best[0])
        assert set(got) == set(want), radius
        for q, (pid, d) in want.items():
            assert got[q][0] == pid or abs(got[q][1] - d) < 1e-6, (radius, q, got[q], pid, d)
    tie = nearest_place(spark.createDataFrame([(0.0, 180.0)], "latitude double, longitude double"), pdf,
                        radius_km=10.0).collect()
    assert tie[0].place_id == 999


def test_add_geography_lookup_keeps_rows(spark):
    places = spark.createDataFrame([(1, 59.9, 10.7, "Oslo", "Norway")],
                                   "place_id long, latitude double, longitude double, county string, state string")
    df = spark.createDataFrame([("a", 59.91, 10.75), ("b", 59.91, 10.75), ("c", None, None), ("d", -33.9, 18.4)],
                               "id string, latitude double, longitude double")
    out = {r.id: (r.county, r.state) for r in add_geography(df, places, radius_km=50).collect()}
    assert out == {"a": ("Oslo", "Norway"), "b": ("Oslo", "Norway"), "c": (None, None), "d": (None, None)}


def test_pairs_per_point_do_not_grow_with_clustered_places(spark):
    """Places in one small region, 16 times as many: the same pairs a point."""
    rng = random.Random(3)
    every = [(i, 59 + rng.random(), 10 + 2 * rng.random(), f"c{i}", "s") for i in range(16000)]
    points = spark.createDataFrame([(58.8 + 1.4 * rng.random(), 9.7 + 2.6 * rng.random()) for _ in range(300)], "latitude double, longitude double")
    mean = []
    for n in (1000, 16000):
        places = spark.createDataFrame(every[:n], "place_id long, latitude double, longitude double, county string, state string")
        pairs = candidate_pairs(points, distinct_places(places), 100.0, "latitude", "longitude").groupBy("q_lat", "q_lon").count().collect()
        assert len(pairs) == 300
        mean.append(sum(r["count"] for r in pairs) / 300)
        got = {(r.latitude, r.longitude): r.place_id for r in nearest_place(points, places).collect()}
        for q, pid in got.items():
            best = min((round(_hav(q, p[1:3]), 6), p[0]) for p in every[:n])
            assert abs(_hav(q, every[pid][1:3]) - best[0]) < 2e-6
    assert mean[1] < 1.5 * mean[0] and mean[1] < 40


def _shuffled_bytes(plan) -> int:
    """Bytes written by the exchanges of a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind.startswith("Reused"):
        return 0
    if kind == "AdaptiveSparkPlanExec":
        return _shuffled_bytes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _shuffled_bytes(plan.plan())
    own = plan.metrics().apply("shuffleBytesWritten").value() if kind == "ShuffleExchangeExec" else 0
    below = plan.children()
    return own + sum(_shuffled_bytes(below.apply(i)) for i in range(below.size()))


def test_near_points_go_down_together(spark):
    """Points of a few cubes: what is shuffled does not hold a list per point;
    a full cube of the last level (places 100 m around) loses none."""
    rng = random.Random(11)
    places = [(i, 59 + rng.random(), 10 + 2 * rng.random(), f"c{i}", "s") for i in range(3000)]
    places += [(i, 59.51 + rng.random() / 1000, 11.01 + rng.random() / 500, f"c{i}", "s") for i in range(3000, 3600)]
    points = [(59.5 + rng.random() / 50, 11 + rng.random() / 50) for _ in range(6000)] + [(59.7, 9.8), (60.1, 11.0)]
    qdf = spark.createDataFrame(points, "latitude double, longitude double")
    pdf = spark.createDataFrame(places, "place_id long, latitude double, longitude double, county string, state string")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "-1")
        found = nearest_place(qdf, pdf, radius_km=50.0)
        got = {(r.latitude, r.longitude): (r.place_id, r.distance_km) for r in found.collect()}
        moved = _shuffled_bytes(found._jdf.queryExecution().executedPlan())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == len(set(points))
    for q in points[::40] + points[-2:]:
        best = min((round(_hav(q, p[1:3]), 6), p[0]) for p in places)
        assert got[q][0] == best[1] or abs(got[q][1] - best[0]) < 2e-6, q
    assert moved < 1700 * len(points), moved / len(points)


def _inside(rings, x, y):
    hits = 0
    for ring in rings:
        if any(abs(a[0] - b[0]) > 180 for a, b in zip(ring, ring[1:] + ring[:1])):
            ring = [(v[0] + 360 * round((ring[0][0] - v[0]) / 360), v[1]) for v in ring]
        for a, b in zip(ring, ring[1:] + ring[:1]):
            (ax, ay), (bx, by) = sorted((a, b), key=lambda v: (v[1], v[0]))
            hits += ((ay > y) != (by > y)) and x < ax + (y - ay) * (bx - ax) / (by - ay)
    return hits % 2 == 1


def _areas(spark, polygons):
    rows = [(i, f"c{i}", f"s{i}", [[(float(x), float(y)) for x, y in ring] for ring in rings]) for i, rings in polygons.items()]
    return spark.createDataFrame(rows, "area_id long, county string, state string, rings array<array<struct<lon:double,lat:double>>>")


def test_containing_area_matches_brute_force(spark):
    rng = random.Random(6)
    star = [(20 + (18 if k % 2 else 7) * math.cos(k * math.pi / 20), 30 + (18 if k % 2 else 7) * math.sin(k * math.pi / 20)) for k in range(40)]
    polygons = {
        1: [star, [(19, 29), (22, 29), (20, 33)]],  # a ragged outline with a hole
        2: [[(19.5, 29.5), (20.5, 29.5), (20.5, 30.5), (19.5, 30.5)]],  # an island in the hole
        3: [[(170, -20), (-170, -25), (-165, 5), (172, 10)]],  # across the date line
        4: [[(-179, 20), (179, 22), (178, 40)]],
        5: [[(-170, -80), (170, -80), (170, -60), (0, -70), (-170, -60)]],  # very wide
        6: [[(40, 40), (40.001, 40), (40.0005, 40.0015)]],  # very small
        7: [[(60, 0), (70, 0), (70, 10), (60, 10)], [(75, 5), (80, 5), (78, 9)]],  # two parts
        8: [[(60, -10), (75, -10), (65, 12)]],  # overlaps 7: the smaller id counts
        9: [[(0, 0), (1, 1)]],  # no area
        10: [],
    }
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(400)]
    points += [(rng.uniform(10, 50), rng.uniform(0, 40)) for _ in range(400)] + [(rng.uniform(-30, 42), rng.choice([-1, 1]) * rng.uniform(160, 180)) for _ in range(400)]
    points += [(rng.uniform(19, 41), rng.choice([rng.uniform(177, 180), rng.uniform(-180, -178.5)])) for _ in range(200)]
    points += [(40 + rng.uniform(-0.0005, 0.002), 40 + rng.uniform(-0.0005, 0.0015)) for _ in range(200)]
    points += [(float(y), float(x)) for x in range(58, 82) for y in range(-11, 13)] + [(30.0, 20.0), (0.0, 180.0), (0.0, -180.0), (90.0, 0.0), (-90.0, 0.0)]
    odd = [(None, 1.0), (1.0, None), (float("nan"), 1.0), (1.0, float("inf")), (91.0, 0.0)]
    df = spark.createDataFrame(points + points[:9] + odd, "latitude double, longitude double").repartition(3)
    got = {(r.latitude, r.longitude): r.area_id for r in containing_area(df, _areas(spark, polygons)).collect()}
    want = {}
    for lat, lon in points:
        hits = [i for i, rings in sorted(polygons.items()) if i != 9 and rings and any(_inside(rings, lon + t, lat) for t in (-360, 0, 360))]
        if hits:
            want[(lat, lon)] = hits[0]
    assert got == want and set(want.values()) >= {1, 2, 3, 4, 5, 6, 7, 8}
    assert containing_area(df, _areas(spark, polygons).limit(0)).count() == 0


def test_a_point_on_a_shared_edge_is_in_one_area(spark):
    """Two halves of a square along a slanted line, tried on points of the line."""
    a, b = (0.0, 0.0), (7.3, 9.1)
    polygons = {1: [[a, b, (0.0, 9.1)]], 2: [[a, (7.3, 0.0), b]]}
    points = [(y / 64, y / 64 * 7.3 / 9.1) for y in range(1, 580)]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    both = [{(r.latitude, r.longitude) for r in containing_area(df, _areas(spark, {i: polygons[i]})).collect()} for i in (1, 2)]
    assert not both[0] & both[1] and both[0] | both[1] == set(points)


def test_add_geography_by_area(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 50.0, 50.0), ("c", None, None)], "id string, latitude double, longitude double")
    out = add_geography(df, areas=_areas(spark, {3: [[(0, 0), (2, 0), (2, 2), (0, 2)]]}))
    assert {r.id: (r.county, r.state) for r in out.collect()} == {"a": ("c3", "s3"), "b": (None, None), "c": (None, None)}


def test_a_cover_moves_lines_of_cells(spark):
    areas = _areas(spark, {1: [[(0, 0), (10, 0), (10, 10), (0, 10)]]})
    plan = cover(areas)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Generate .*\[cx#", plan).start() < plan.index("Join LeftOuter"), plan
    points = spark.createDataFrame([(5.0, 5.0)], "latitude double, longitude double")
    assert "Rebalance" not in containing_area(points, areas)._jdf.queryExecution().optimizedPlan().toString()
