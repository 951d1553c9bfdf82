"""Bronze tables derived from the shipped TPC-H-style Parquet.

The shipped data is clean, so defects are injected at fixed key residues
(NULL and repeated ids, bad dates, out-of-range coordinates, non-members).
The same derivations, as SQL text, are in FIXTURES.md; both engines give
identical rows.  ``batch`` selects a step of the three-batch change
scenario (1: some keys absent; 2: others absent, some updated, some made
invalid; 3 or None: everything as derived).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHIPPED = ("region", "nation", "customer", "orders", "lineitem")


def read_shipped(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one shipped table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _null() -> Column:
    return F.lit(None).cast("string")


def _batch_filter(k: Column, batch: int | None) -> Column:
    if batch == 1:
        return k % 10 != 3
    if batch == 2:
        return k % 10 != 2
    return F.lit(True)


def bronze_teams(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    nation = read_shipped(spark, sf_dir, "nation")
    region = read_shipped(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    activity = F.when(k == 21, _null()).otherwise(F.col("r_name"))
    if batch == 2:
        activity = F.when(k % 10 == 1, F.lit("CHANGED")).otherwise(activity)
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where(_batch_filter(k, batch)).select(
        F.when(k == 22, _null()).when(k == 24, F.lit("T23")).otherwise(F.concat(F.lit("T"), _s(k))).alias("team_id"),
        activity.alias("team_activity"),
        F.when(k == 20, _null()).otherwise(F.col("n_name")).alias("country_code"),
        F.when(k == 19, F.lit("not-a-date"))
        .otherwise(F.concat(F.lit("2023-01-0"), _s(1 + k % 9), F.lit(" 08:00:00"))).alias("created_at"),
    )


def bronze_memberships(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    c = F.col("c_custkey")
    role = (F.when(c % 89 == 3, _null()).when(F.col("c_mktsegment") == "BUILDING", F.lit("admin"))
            .when((F.col("c_mktsegment") == "MACHINERY") & (c % 5 == 0), F.lit("guest")).otherwise(F.lit("member")))
    joined = (F.when(c % 83 == 2, F.lit("2024-02-30"))
              .otherwise(F.concat(F.lit("2023-0"), _s(1 + c % 9), F.lit("-1"), _s(c % 10), F.lit(" 09:30:00"))))
    if batch == 2:
        upd = c % 10 == 1
        role = (F.when(upd & (role == "member"), F.lit("admin"))
                .when(upd & (role == "admin"), F.lit("member")).otherwise(role))
        joined = (F.when(upd & F.try_to_timestamp(joined).isNotNull(), F.lit("2023-11-01 09:30:00"))
                  .when(c % 10 == 4, F.lit("bad")).otherwise(joined))
    return read_shipped(spark, sf_dir, "customer").where(_batch_filter(c, batch)).select(
        F.when(c % 97 == 5, _null()).when(c % 101 == 7, F.concat(F.lit("M"), _s(c - 1)))
        .otherwise(F.concat(F.lit("M"), _s(c))).alias("membership_id"),
        F.concat(F.lit("T"), _s(F.col("c_nationkey"))).alias("group_id"),
        role.alias("role_title"),
        joined.alias("joined_at"),
    )


def joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the events of every batch are derived from."""
    orders = read_shipped(spark, sf_dir, "orders")
    customer = read_shipped(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "c_nationkey")


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the RSVPs of every batch are derived from."""
    orders = read_shipped(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return read_shipped(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_custkey")


def bronze_events(spark: SparkSession, sf_dir: str, batch: int | None = None, joined: DataFrame | None = None) -> DataFrame:
    o = F.col("o_orderkey")
    start = F.when(o % 193 == 6, F.lit("TBD")).otherwise(_s(F.col("o_orderdate")))
    lat = F.when((o % 173 == 11) | (o % 163 == 13), F.lit(None).cast("double")).otherwise((o % 181 - 90).cast("double"))
    lon = (F.when(o % 167 == 12, F.lit(200.0)).when(o % 163 == 13, F.lit(None).cast("double"))
           .otherwise((o % 361 - 180).cast("double")))
    created = F.concat(F.lit("1994-12-0"), _s(1 + o % 9), F.lit(" 12:00:00"))
    if batch == 2:
        upd = o % 10 == 1
        lat = F.when(upd, F.lit(10.0)).otherwise(lat)
        lon = F.when(upd, F.lit(20.0)).otherwise(lon)
        created = F.when(upd, F.lit("1995-01-01 12:00:00")).otherwise(created)
        start = F.when(o % 10 == 4, F.lit("TBD")).otherwise(start)
    rows = joined_orders(spark, sf_dir) if joined is None else joined
    return rows.where(_batch_filter(o, batch)).select(
        F.when(o % 211 == 9, _null()).when(o % 199 == 5, F.concat(F.lit("E"), _s(o - 1)))
        .otherwise(F.concat(F.lit("E"), _s(o))).alias("event_id"),
        F.concat(F.lit("T"), _s(F.col("c_nationkey"))).alias("team_id"),
        start.alias("event_start"),
        F.when(o % 181 == 8, F.lit("1990-01-01 00:00:00")).when(o % 179 == 10, _s(F.col("o_orderdate")))
        .otherwise(_s(F.col("o_orderdate") + F.expr("INTERVAL 2 HOURS"))).alias("event_end"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        created.alias("created_at"),
    )


def bronze_rsvps(spark: SparkSession, sf_dir: str, batch: int | None = None, joined: DataFrame | None = None) -> DataFrame:
    ln, ok = F.col("l_linenumber"), F.col("l_orderkey")
    status = F.when(ln == 6, F.lit(None)).when(ln == 7, F.lit(0)).otherwise(ln - 1)
    responded = F.when((ln == 1) & (ok % 151 == 3), F.lit("")).otherwise(_s(F.col("l_shipdate")))
    lines = joined_lines(spark, sf_dir) if joined is None else joined
    if batch in (1, 2):
        # Some answers are missing from either batch; in the second some change, one in part.
        lines = lines.where(_batch_filter(ok + ln, batch))
    if batch == 2:
        changed = (ok + ln) % 10 == 1
        status = F.when(changed & status.isNotNull(), (status + 1) % 4).otherwise(status)
        responded = F.when(changed & (ln == 2), _s(F.col("l_shipdate") + F.expr("INTERVAL 1 DAY"))).otherwise(responded)
    return lines.select(
        F.concat(F.lit("R"), _s(ok), F.lit("-"), _s(ln), F.lit("-"), _s(F.col("l_partkey"))).alias("event_rsvp_id"),
        F.concat(F.lit("E"), _s(ok)).alias("event_id"),
        F.concat(F.lit("M"), _s(F.when(ln == 7, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))).alias("membership_id"),
        status.cast("bigint").alias("rsvp_status"),
        responded.alias("responded_at"),
    )


BRONZE = {
    "teams": bronze_teams,
    "memberships": bronze_memberships,
    "events": bronze_events,
    "event_rsvps": bronze_rsvps,
}


class _Bronze(dict):
    """Bronze frames built on first access."""

    def __init__(self, spark: SparkSession, sf_dir: str, batch: int | None, joined: dict[str, DataFrame]):
        super().__init__()
        self._args = (spark, sf_dir, batch)
        self._joined = joined

    def __missing__(self, name: str) -> DataFrame:
        self[name] = BRONZE[name](*self._args, *([self._joined[name]] if name in self._joined else []))
        return self[name]


# The joins below two of the tables; they do not depend on the batch.
JOINED = {"events": joined_orders, "event_rsvps": joined_lines}


def bronze_tables(spark: SparkSession, sf_dir: str, batch: int | None = None,
                  joined: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """``joined``: the frames of ``JOINED``, stored for several readers."""
    return _Bronze(spark, sf_dir, batch, joined or {})


def places_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place table that grows with the data: one place per customer, at a
    position spread by its key, named after the customer and its nation."""
    customer = read_shipped(spark, sf_dir, "customer")
    nation = read_shipped(spark, sf_dir, "nation")
    c = F.col("c_custkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        c.alias("place_id"),
        ((c * 7) % 181 - 90).cast("double").alias("latitude"),
        ((c * 13) % 361 - 180).cast("double").alias("longitude"),
        F.col("c_name").alias("county"),
        F.col("n_name").alias("state"),
    )


def clustered_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One place per customer, all in a region of one by two degrees, so that
    they get denser with the data."""
    c = F.col("c_custkey")
    return places_from_customers(spark, sf_dir).withColumnRenamed("place_id", "c_custkey").select(
        c.alias("place_id"), (F.lit(59.0) + (c * 7) % 10007 / F.lit(10007.0)).alias("latitude"),
        (F.lit(10.0) + (c * 13) % 20011 / F.lit(10005.5)).alias("longitude"), "county", "state")


def points_around(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per order in and around that region."""
    o = F.col("o_orderkey")
    return read_shipped(spark, sf_dir, "orders").select(
        (F.lit(59.5) + (o % 1009 - 504) / F.lit(600.0)).alias("latitude"), (F.lit(11.0) + ((o * 3) % 2003 - 1001) / F.lit(800.0)).alias("longitude"))


def areas_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area per customer: a four-cornered one, every third with a hole,
    some across the date line; neighbours of one row share edges."""
    customer = read_shipped(spark, sf_dir, "customer")
    nation = read_shipped(spark, sf_dir, "nation")
    c = F.col("c_custkey")
    x, y = c % 36 * 10 - 175, F.floor(c / 36) % 17 * 10 - 85
    outer = ((0, 0), (10, 0), (13, 10), (3, 10))
    hole = ((4, 3), (7, 3), (8, 6), (5, 7))

    def ring(corners):
        lon = [x + dx for dx, _ in corners]
        return F.array(*[F.struct(F.when(v > 180, v - 360).otherwise(v).cast("double").alias("lon"), (y + dy).cast("double").alias("lat"))
                         for v, (_, dy) in zip(lon, corners)])

    rings = F.when(c % 3 == 0, F.array(ring(outer), ring(hole))).otherwise(F.array(ring(outer)))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        c.alias("area_id"), F.col("c_name").alias("county"), F.col("n_name").alias("state"), rings.alias("rings"))
