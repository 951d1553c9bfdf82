"""Independent DuckDB formulations of the registered queries.

Plain SQL over the shipped tables (region, nation, customer, orders,
lineitem), written from the rule definitions, not from the Spark code.
Bronze derivations are the SQL of FIXTURES.md.  Checks use window counts
and EXISTS subqueries; the histories use explicit CASE logic per batch.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Bronze (FIXTURES.md section 3), with the three-batch variants of section 5.
# --------------------------------------------------------------------------


def _b_teams(batch=None):
    keep = {1: "n_nationkey % 10 <> 3", 2: "n_nationkey % 10 <> 2"}.get(batch, "true")
    act = "case when n_nationkey=21 then null else r_name end"
    if batch == 2:
        act = f"case when n_nationkey % 10 = 1 then 'CHANGED' else {act} end"
    return f"""select case when n_nationkey=22 then null when n_nationkey=24 then 'T23' else 'T'||cast(n_nationkey as string) end team_id,
 {act} team_activity, case when n_nationkey=20 then null else n_name end country_code,
 case when n_nationkey=19 then 'not-a-date' else '2023-01-0'||cast(1+n_nationkey%9 as string)||' 08:00:00' end created_at
 from nation join region on n_regionkey=r_regionkey where {keep}"""


def _b_memberships(batch=None):
    keep = {1: "c_custkey % 10 <> 3", 2: "c_custkey % 10 <> 2"}.get(batch, "true")
    role = ("case when c_custkey%89=3 then null when c_mktsegment='BUILDING' then 'admin' "
            "when c_mktsegment='MACHINERY' and c_custkey%5=0 then 'guest' else 'member' end")
    joined = ("case when c_custkey%83=2 then '2024-02-30' else '2023-0'||cast(1+c_custkey%9 as string)"
              "||'-1'||cast(c_custkey%10 as string)||' 09:30:00' end")
    if batch == 2:
        role = (f"case when c_custkey%10=1 and {role}='member' then 'admin' "
                f"when c_custkey%10=1 and {role}='admin' then 'member' else {role} end")
        joined = (f"case when c_custkey%10=1 and try_cast({joined} as timestamp) is not null then '2023-11-01 09:30:00' "
                  f"when c_custkey%10=4 then 'bad' else {joined} end")
    return f"""select case when c_custkey%97=5 then null when c_custkey%101=7 then 'M'||cast(c_custkey-1 as string) else 'M'||cast(c_custkey as string) end membership_id,
 'T'||cast(c_nationkey as string) group_id, {role} role_title, {joined} joined_at from customer where {keep}"""


def _b_events(batch=None):
    keep = {1: "o_orderkey % 10 <> 3", 2: "o_orderkey % 10 <> 2"}.get(batch, "true")
    start = "case when o_orderkey%193=6 then 'TBD' else cast(o_orderdate as string) end"
    lat = "case when o_orderkey%173=11 or o_orderkey%163=13 then null else cast(o_orderkey%181-90 as double) end"
    lon = ("case when o_orderkey%167=12 then cast(200 as double) when o_orderkey%163=13 then null "
           "else cast(o_orderkey%361-180 as double) end")
    created = "'1994-12-0'||cast(1+o_orderkey%9 as string)||' 12:00:00'"
    if batch == 2:
        lat = f"case when o_orderkey%10=1 then 10.0 else {lat} end"
        lon = f"case when o_orderkey%10=1 then 20.0 else {lon} end"
        created = f"case when o_orderkey%10=1 then '1995-01-01 12:00:00' else {created} end"
        start = f"case when o_orderkey%10=4 then 'TBD' else {start} end"
    return f"""select case when o_orderkey%211=9 then null when o_orderkey%199=5 then 'E'||cast(o_orderkey-1 as string) else 'E'||cast(o_orderkey as string) end event_id,
 'T'||cast(c_nationkey as string) team_id, {start} event_start,
 case when o_orderkey%181=8 then '1990-01-01 00:00:00' when o_orderkey%179=10 then cast(o_orderdate as string) else cast(o_orderdate + interval 2 hour as string) end event_end,
 {lat} latitude, {lon} longitude, {created} created_at from orders join customer on o_custkey=c_custkey where {keep}"""


def _b_rsvps(batch=None):
    keep = {1: "(l_orderkey + l_linenumber) % 10 <> 3", 2: "(l_orderkey + l_linenumber) % 10 <> 2"}.get(batch, "true")
    status = "case when l_linenumber=6 then null when l_linenumber=7 then 0 else l_linenumber-1 end"
    responded = "case when l_linenumber=1 and l_orderkey%151=3 then '' else cast(l_shipdate as string) end"
    if batch == 2:
        changed = "(l_orderkey + l_linenumber) % 10 = 1"
        status = f"case when {changed} and l_linenumber <> 6 then (({status}) + 1) % 4 else {status} end"
        responded = f"case when {changed} and l_linenumber=2 then cast(l_shipdate + interval 1 day as string) else {responded} end"
    return f"""select 'R'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string) event_rsvp_id, 'E'||cast(l_orderkey as string) event_id,
 'M'||cast(case when l_linenumber=7 then o_custkey+1 else o_custkey end as string) membership_id,
 cast({status} as bigint) rsvp_status, {responded} responded_at
 from lineitem join orders on l_orderkey=o_orderkey where {keep}"""


def digest(cols: list[str]) -> str:
    parts = [f"coalesce(cast(length(cast({c} as varchar)) as varchar) || ':' || cast({c} as varchar), '-')"
             for c in cols]
    return "sha256(" + " || ".join(parts) + ")"


def dk(c: str) -> str:
    return f"cast(strftime({c}, '%Y%m%d') as int)"


TS = "try_cast({} as timestamp)"

TEAM_COLS = ["team_id", "team_activity", "country_code", "created_at", "created_at_datekey"]
MEM_COLS = ["membership_id", "group_id", "role_title", "joined_at", "joined_at_datekey"]
EVT_COLS = ["event_id", "team_id", "event_start", "event_start_datekey", "event_end", "event_end_datekey",
            "latitude", "longitude", "created_at", "created_at_datekey", "county", "state"]
RSVP_COLS = ["event_rsvp_id", "event_id", "membership_id", "rsvp_status", "responded_at", "responded_at_datekey"]
SCD1_SYS = ["hash_key", "system_created_at", "system_updated_at"]
SCD2_SYS = ["hash_key", "system_is_active", "system_valid_from", "system_valid_to"]


def pipeline_ctes(s: str = "", batch=None, teams_parent: str | None = None, with_rsvps: bool = True,
                  parts: tuple[str, ...] = ("teams", "children"), events_parent: str | None = None,
                  members_parent: str | None = None) -> str:
    """CTEs b_*{s}, *_tag{s} (raw + dq_reason), *_acc{s} (stamped silver rows).

    ``parts`` picks the teams block and/or the memberships + events block
    (+ RSVPs when ``with_rsvps``), so parents defined in between can be used."""
    tp = teams_parent or f"teams_acc{s}"
    ep = events_parent or f"events_acc{s}"
    mp = members_parent or f"memberships_acc{s}"
    teams_part = f"""
b_teams{s} AS ({_b_teams(batch)}),
teams_tag{s} AS (
  SELECT b.*, CASE
    WHEN team_id IS NULL THEN 'null_key'
    WHEN count(*) OVER (PARTITION BY team_id) > 1 THEN 'duplicate_key'
    WHEN {TS.format('created_at')} IS NULL THEN 'bad_timestamp'
    WHEN country_code IS NULL THEN 'null_country'
    WHEN team_activity IS NULL THEN 'null_activity' END AS dq_reason
  FROM b_teams{s} b),
teams_acc{s} AS (
  SELECT *, {digest(TEAM_COLS)} AS hash_key, created_at AS system_created_at, created_at AS system_updated_at
  FROM (SELECT team_id, team_activity, country_code, {TS.format('created_at')} AS created_at,
               {dk(TS.format('created_at'))} AS created_at_datekey
        FROM teams_tag{s} WHERE dq_reason IS NULL))"""
    out = f"""
b_memberships{s} AS ({_b_memberships(batch)}),
b_events{s} AS ({_b_events(batch)}),
memberships_tag{s} AS (
  SELECT b.*, CASE
    WHEN membership_id IS NULL THEN 'null_key'
    WHEN count(*) OVER (PARTITION BY membership_id) > 1 THEN 'duplicate_key'
    WHEN NOT EXISTS (SELECT 1 FROM {tp} t WHERE t.team_id = b.group_id) THEN 'unknown_group_id'
    WHEN {TS.format('joined_at')} IS NULL THEN 'bad_timestamp'
    WHEN role_title IS NULL OR role_title NOT IN ('member', 'admin') THEN 'bad_role' END AS dq_reason
  FROM b_memberships{s} b),
memberships_acc{s} AS (
  SELECT *, {digest(MEM_COLS)} AS hash_key, true AS system_is_active, joined_at AS system_valid_from,
         cast(NULL AS timestamp) AS system_valid_to
  FROM (SELECT membership_id, group_id, role_title, {TS.format('joined_at')} AS joined_at,
               {dk(TS.format('joined_at'))} AS joined_at_datekey
        FROM memberships_tag{s} WHERE dq_reason IS NULL)),
events_typed{s} AS (
  SELECT b.*, {TS.format('event_start')} AS s_ts, {TS.format('event_end')} AS e_ts,
         {TS.format('created_at')} AS c_ts, count(*) OVER (PARTITION BY event_id) AS n_id
  FROM b_events{s} b),
events_tag{s} AS (
  SELECT event_id, team_id, event_start, event_end, latitude, longitude, created_at, s_ts, e_ts, c_ts, CASE
    WHEN event_id IS NULL THEN 'null_key'
    WHEN n_id > 1 THEN 'duplicate_key'
    WHEN NOT EXISTS (SELECT 1 FROM {tp} t WHERE t.team_id = b.team_id) THEN 'unknown_team_id'
    WHEN s_ts IS NULL OR e_ts IS NULL OR c_ts IS NULL THEN 'bad_timestamp'
    WHEN s_ts > e_ts THEN 'start_after_end'
    WHEN s_ts = e_ts THEN 'zero_length'
    WHEN (latitude IS NULL) <> (longitude IS NULL) THEN 'half_null_coordinates'
    WHEN latitude IS NOT NULL AND NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)
      THEN 'coordinates_out_of_range' END AS dq_reason
  FROM events_typed{s} b),
events_acc{s} AS (
  SELECT *, {digest(EVT_COLS)} AS hash_key, true AS system_is_active, created_at AS system_valid_from,
         cast(NULL AS timestamp) AS system_valid_to
  FROM (SELECT event_id, team_id, s_ts AS event_start, {dk('s_ts')} AS event_start_datekey,
               e_ts AS event_end, {dk('e_ts')} AS event_end_datekey, latitude, longitude,
               c_ts AS created_at, {dk('c_ts')} AS created_at_datekey,
               'Oslo county' AS county, 'Norway' AS state
        FROM events_tag{s} WHERE dq_reason IS NULL))"""
    if with_rsvps:
        out += f""",
b_rsvps{s} AS ({_b_rsvps(batch)}),
rsvps_tag{s} AS (
  SELECT b.*, CASE
    WHEN event_rsvp_id IS NULL THEN 'null_key'
    WHEN count(*) OVER (PARTITION BY event_rsvp_id) > 1 THEN 'duplicate_key'
    WHEN NOT EXISTS (SELECT 1 FROM {ep} e WHERE e.event_id = b.event_id) THEN 'unknown_event_id'
    WHEN NOT EXISTS (SELECT 1 FROM {mp} m WHERE m.membership_id = b.membership_id)
      THEN 'unknown_membership_id'
    WHEN {TS.format('responded_at')} IS NULL THEN 'bad_timestamp'
    WHEN rsvp_status IS NULL OR rsvp_status NOT BETWEEN 0 AND 3 THEN 'status_range'
    WHEN NOT EXISTS (SELECT 1 FROM {ep} e JOIN {mp} m ON m.group_id = e.team_id
                     WHERE e.event_id = b.event_id AND m.membership_id = b.membership_id)
      THEN 'not_team_member' END AS dq_reason
  FROM b_rsvps{s} b),
rsvps_acc{s} AS (
  SELECT *, {digest(RSVP_COLS)} AS hash_key, responded_at AS system_created_at,
         responded_at AS system_updated_at
  FROM (SELECT event_rsvp_id, event_id, membership_id, rsvp_status, {TS.format('responded_at')} AS responded_at,
               {dk(TS.format('responded_at'))} AS responded_at_datekey
        FROM rsvps_tag{s} WHERE dq_reason IS NULL))"""
    chunks = ([teams_part] if "teams" in parts else []) + ([out] if "children" in parts else [])
    return ",".join(c.rstrip() for c in chunks)


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip().lstrip(",") + "\n" + body


def _cols(cols: list[str], alias: str = "") -> str:
    return ", ".join(f"{alias}{c}" for c in cols)


# --------------------------------------------------------------------------
# Type-1 / type-2 steps in SQL
# --------------------------------------------------------------------------


def scd1_step(name: str, target: str, batch: str, key: str, cols: list[str]) -> str:
    """CTE ``name``: upsert of ``batch`` into ``target`` with a change label."""
    allc = cols + SCD1_SYS
    sel = []
    for c in allc:
        if c == "system_created_at":
            sel.append(f"CASE WHEN t.{key} IS NULL THEN b.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN t.{key} IS NULL OR (b.{key} IS NOT NULL AND t.hash_key <> b.hash_key) "
                       f"THEN b.{c} ELSE t.{c} END AS {c}")
    return f""",
{name} AS (
  SELECT {', '.join(sel)},
    CASE WHEN t.{key} IS NULL THEN 'new' WHEN b.{key} IS NULL THEN 'kept'
         WHEN t.hash_key = b.hash_key THEN 'same' ELSE 'changed' END AS change
  FROM {target} t FULL OUTER JOIN {batch} b ON t.{key} = b.{key})"""


def scd2_step(name: str, target: str, batch: str, raw: str | None, key: str, cols: list[str], as_of: str) -> str:
    """CTE ``name``: next type-2 table (with change labels) for one batch.

    ``raw``: CTE of the raw batch (keys present in the source); None closes
    every active key without an accepted row."""
    allc = cols + SCD2_SYS
    present = (f"EXISTS (SELECT 1 FROM {raw} r WHERE r.{key} = t.{key})" if raw else "false")
    old = ", ".join(
        f"CASE WHEN cls IN ('changed','departed') THEN false ELSE t.system_is_active END AS {c}" if c == "system_is_active"
        else (f"CASE WHEN cls = 'changed' THEN b.system_valid_from WHEN cls = 'departed' "
              f"THEN TIMESTAMP '{as_of}' ELSE t.system_valid_to END AS {c}") if c == "system_valid_to"
        else f"t.{c} AS {c}" for c in allc)
    return f""",
{name}_j AS (
  SELECT t.*, b.{key} AS b_key, CASE
      WHEN b.{key} IS NOT NULL AND t.hash_key = b.hash_key THEN 'same'
      WHEN b.{key} IS NOT NULL THEN 'changed'
      WHEN {present} THEN 'held' ELSE 'departed' END AS cls
  FROM (SELECT * FROM {target} WHERE system_is_active) t LEFT JOIN {batch} b ON t.{key} = b.{key}),
{name} AS (
  SELECT {_cols(allc)}, 'history' AS change FROM {target} WHERE NOT coalesce(system_is_active, false)
  UNION ALL
  SELECT {old}, CASE WHEN cls = 'changed' THEN 'superseded' ELSE cls END AS change
  FROM {name}_j t LEFT JOIN {batch} b ON t.b_key = b.{key}
  UNION ALL
  SELECT {_cols(allc, 'b.')}, CASE WHEN t.{key} IS NULL THEN 'new' ELSE 'changed' END AS change
  FROM {batch} b LEFT JOIN (SELECT * FROM {target} WHERE system_is_active) t ON t.{key} = b.{key}
  WHERE t.{key} IS NULL OR t.hash_key <> b.hash_key)"""


AS_OF = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]


def scenario_ctes(close_rejected: bool = False, with_rsvps: bool = False, every_rsvps: bool = False) -> str:
    """Three batches through teams (SCD1), memberships and events (SCD2).
    Parents of each batch: the accepted teams of the whole data."""
    ctes = pipeline_ctes("", None, with_rsvps=with_rsvps)
    tp = "teams_acc"
    for i in (1, 2):
        ctes += "," + pipeline_ctes(f"_{i}", i, teams_parent=tp, with_rsvps=every_rsvps).strip()
    ctes += f""",
teams_s0 AS (SELECT {_cols(TEAM_COLS + SCD1_SYS)} FROM teams_acc_1 WHERE false),
mem_s0 AS (SELECT {_cols(MEM_COLS + SCD2_SYS)} FROM memberships_acc_1 WHERE false),
evt_s0 AS (SELECT {_cols(EVT_COLS + SCD2_SYS)} FROM events_acc_1 WHERE false)"""
    suffix = {1: "_1", 2: "_2", 3: ""}
    for i in (1, 2, 3):
        s = suffix[i]
        ctes += scd1_step(f"teams_s{i}_c", f"teams_s{i - 1}", f"teams_acc{s}", "team_id", TEAM_COLS)
        ctes += f",\nteams_s{i} AS (SELECT {_cols(TEAM_COLS + SCD1_SYS)} FROM teams_s{i}_c)"
        raw_m = None if close_rejected else f"b_memberships{s}"
        raw_e = None if close_rejected else f"b_events{s}"
        ctes += scd2_step(f"mem_s{i}_c", f"mem_s{i - 1}", f"memberships_acc{s}", raw_m, "membership_id",
                          MEM_COLS, AS_OF[i - 1])
        ctes += f",\nmem_s{i} AS (SELECT {_cols(MEM_COLS + SCD2_SYS)} FROM mem_s{i}_c)"
        ctes += scd2_step(f"evt_s{i}_c", f"evt_s{i - 1}", f"events_acc{s}", raw_e, "event_id", EVT_COLS,
                          AS_OF[i - 1])
        ctes += f",\nevt_s{i} AS (SELECT {_cols(EVT_COLS + SCD2_SYS)} FROM evt_s{i}_c)"
    return ctes


def _scenario_counts(close_rejected: bool) -> str:
    parts = []
    for i in (1, 2, 3):
        for table, cte in (("teams", f"teams_s{i}_c"), ("memberships", f"mem_s{i}_c"), ("events", f"evt_s{i}_c")):
            parts.append(f"SELECT '{table}' AS table_name, {i} AS batch, change, count(*) AS rows "
                         f"FROM {cte} GROUP BY change")
    return with_(scenario_ctes(close_rejected), "\nUNION ALL\n".join(parts))


# --------------------------------------------------------------------------
# Registered queries
# --------------------------------------------------------------------------

P = pipeline_ctes()
RAW_RSVP = "event_rsvp_id, event_id, membership_id, rsvp_status, responded_at"
RAW_TEAM = "team_id, team_activity, country_code, created_at"
RAW_MEM = "membership_id, group_id, role_title, joined_at"
RAW_EVT = "event_id, team_id, event_start, event_end, latitude, longitude, created_at"


def _distance() -> str:
    return ("2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin((radians(p.latitude) - radians(q.latitude)) / 2), 2) "
         "+ cos(radians(q.latitude)) * cos(radians(p.latitude)) "
         "* pow(sin((radians(p.longitude) - radians(q.longitude)) / 2), 2))))")


def geo_ctes(radius_km: float) -> str:
    d = _distance()
    return f"""
places AS (SELECT c_custkey AS place_id, cast((c_custkey * 7) % 181 - 90 AS double) AS latitude,
                  cast((c_custkey * 13) % 361 - 180 AS double) AS longitude, c_name AS county, n_name AS state
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
q AS (SELECT DISTINCT latitude, longitude FROM b_events WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
c AS (SELECT q.latitude, q.longitude, p.place_id, p.county, p.state, round({d}, 6) AS distance_km
      FROM q, places p),
r AS (SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY distance_km, place_id) AS rn
      FROM c WHERE distance_km <= {radius_km})"""


def _geo_nearest(radius_km: float) -> str:
    return with_(f"b_events AS ({_b_events()})," + geo_ctes(radius_km),
                 "SELECT latitude, longitude, place_id, distance_km, county, state FROM r WHERE rn = 1")


def _geo_clustered(radius_km: float) -> str:
    """Every point against every place, both in one small region."""
    return f"""WITH places AS (SELECT c_custkey AS place_id, 59.0::double + (c_custkey * 7) % 10007 / 10007.0::double AS latitude,
  10.0::double + (c_custkey * 13) % 20011 / 10005.5::double AS longitude, c_name AS county, n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
q AS (SELECT DISTINCT 59.5::double + (o_orderkey % 1009 - 504) / 600.0::double AS latitude,
  11.0::double + ((o_orderkey * 3) % 2003 - 1001) / 800.0::double AS longitude FROM orders),
c AS (SELECT q.latitude, q.longitude, p.place_id, p.county, p.state, round({_distance()}, 6) AS distance_km FROM q, places p),
r AS (SELECT latitude, longitude, min(struct_pack(d := distance_km, i := place_id, c := county, s := state)) AS b
      FROM c WHERE distance_km <= {radius_km} GROUP BY 1, 2)
SELECT latitude, longitude, b.i AS place_id, b.d AS distance_km, b.c AS county, b.s AS state FROM r"""


def _geo_within() -> str:
    """Every point against every area: crossings of all edges to its right,
    corners laid out without regard to the date line and points moved by whole
    turns instead."""
    outer, hole = ((0, 0), (10, 0), (13, 10), (3, 10)), ((4, 3), (7, 3), (8, 6), (5, 7))
    edges = []
    for corners, cond in ((outer, "true"), (hole, "area_id % 3 = 0")):
        for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
            (ax, ay), (bx, by) = sorted(((ax, ay), (bx, by)), key=lambda v: (v[1], v[0]))
            edges.append(f"SELECT area_id, (x + {ax})::double AS xa, (y + {ay})::double AS ya, (x + {bx})::double AS xb, (y + {by})::double AS yb FROM areas WHERE {cond}")
    return with_(f"""b_events AS ({_b_events()}),
areas AS (SELECT c_custkey AS area_id, c_name AS county, n_name AS state, c_custkey % 36 * 10 - 175 AS x, (c_custkey // 36) % 17 * 10 - 85 AS y
          FROM customer JOIN nation ON c_nationkey = n_nationkey),
edges AS ({" UNION ALL ".join(edges)}),
q AS (SELECT DISTINCT latitude, longitude FROM b_events WHERE abs(latitude) <= 90 AND abs(longitude) <= 360),
near AS (SELECT q.latitude, q.longitude, q.longitude + t AS lon, a.area_id FROM q, (VALUES (-360.0::double), (0.0), (360.0)) turns(t), areas a
         WHERE q.latitude BETWEEN a.y AND a.y + 10 AND q.longitude + t BETWEEN a.x AND a.x + 13),
hits AS (SELECT n.latitude, n.longitude, n.lon, n.area_id FROM near n JOIN edges e ON n.area_id = e.area_id
         WHERE (e.ya > n.latitude) <> (e.yb > n.latitude) AND n.lon < e.xa + (n.latitude - e.ya) * (e.xb - e.xa) / (e.yb - e.ya)
         GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1),
found AS (SELECT latitude, longitude, min(area_id) AS area_id FROM hits GROUP BY 1, 2)""",
                 "SELECT f.latitude, f.longitude, f.area_id, a.county, a.state FROM found f JOIN areas a ON a.area_id = f.area_id")


def _raw_values(cols: str) -> str:
    return " || '|' || ".join(f"coalesce(cast({c} as varchar), '-')" for c in cols.split(", "))


def _quarantined(suffix: str, rsvp_suffix: str) -> str:
    parts = []
    for table, cte, key, cols in (("teams", f"teams_tag{suffix}", "team_id", RAW_TEAM), ("memberships", f"memberships_tag{suffix}", "membership_id", RAW_MEM),
                                  ("events", f"events_tag{suffix}", "event_id", RAW_EVT), ("event_rsvps", f"rsvps_tag{rsvp_suffix}", "event_rsvp_id", RAW_RSVP)):
        parts.append(f"SELECT '{table}' AS table_name, {key} AS record_key, dq_reason, {_raw_values(cols)} AS raw_values FROM {cte} WHERE dq_reason IS NOT NULL")
    return "\nUNION ALL\n".join(parts)


QUERIES: dict[str, str] = {
    # sources
    "bronze_teams": with_(P, "SELECT * FROM b_teams"),
    "bronze_memberships": with_(P, "SELECT * FROM b_memberships"),
    "bronze_events": with_(P, "SELECT * FROM b_events"),
    "bronze_rsvps": with_(P, "SELECT * FROM b_rsvps"),
    # O1
    "id_accepted": with_(P, f"""SELECT {RAW_RSVP} FROM (SELECT *, count(*) OVER (PARTITION BY event_rsvp_id) n
        FROM b_rsvps) WHERE event_rsvp_id IS NOT NULL AND n = 1"""),
    "id_rejected": with_(P, f"""SELECT {RAW_RSVP}, CASE WHEN event_rsvp_id IS NULL THEN 'null_key' ELSE 'duplicate_key' END
        AS dq_reason FROM (SELECT *, count(*) OVER (PARTITION BY event_rsvp_id) n FROM b_rsvps)
        WHERE event_rsvp_id IS NULL OR n > 1"""),
    # O2
    "fk_accepted": with_(P, """SELECT membership_id, group_id, role_title, joined_at FROM b_memberships b
        WHERE EXISTS (SELECT 1 FROM teams_acc t WHERE t.team_id = b.group_id)"""),
    "fk_rejected": with_(P, """SELECT membership_id, group_id, role_title, joined_at, 'unknown_group_id' AS dq_reason
        FROM b_memberships b WHERE NOT EXISTS (SELECT 1 FROM teams_acc t WHERE t.team_id = b.group_id)"""),
    "fk_multi_accepted": with_(P, f"""SELECT {RAW_RSVP} FROM b_rsvps b
        WHERE EXISTS (SELECT 1 FROM events_acc e WHERE e.event_id = b.event_id)
          AND EXISTS (SELECT 1 FROM memberships_acc m WHERE m.membership_id = b.membership_id)"""),
    "fk_multi_rejected": with_(P, f"""SELECT {RAW_RSVP}, CASE
          WHEN NOT EXISTS (SELECT 1 FROM events_acc e WHERE e.event_id = b.event_id) THEN 'unknown_event_id'
          ELSE 'unknown_membership_id' END AS dq_reason FROM b_rsvps b
        WHERE NOT EXISTS (SELECT 1 FROM events_acc e WHERE e.event_id = b.event_id)
           OR NOT EXISTS (SELECT 1 FROM memberships_acc m WHERE m.membership_id = b.membership_id)"""),
    # O3
    "ts_accepted": with_(P, f"""SELECT event_id, team_id, s_ts AS event_start, e_ts AS event_end, latitude, longitude,
        c_ts AS created_at FROM events_typed WHERE s_ts IS NOT NULL AND e_ts IS NOT NULL AND c_ts IS NOT NULL"""),
    "ts_rejected": with_(P, f"""SELECT {RAW_EVT}, 'bad_timestamp' AS dq_reason FROM events_typed
        WHERE s_ts IS NULL OR e_ts IS NULL OR c_ts IS NULL"""),
    # O4
    "team_rules_accepted": with_(P, "SELECT * FROM b_teams WHERE country_code IS NOT NULL AND team_activity IS NOT NULL"),
    "team_rules_rejected": with_(P, """SELECT *, CASE WHEN country_code IS NULL THEN 'null_country'
        ELSE 'null_activity' END AS dq_reason FROM b_teams WHERE country_code IS NULL OR team_activity IS NULL"""),
    # O5 (after parsing the three timestamps)
    "event_rules_accepted": with_(P, """SELECT event_id, team_id, s_ts AS event_start, e_ts AS event_end, latitude,
        longitude, c_ts AS created_at FROM events_typed WHERE s_ts IS NOT NULL AND e_ts IS NOT NULL
        AND c_ts IS NOT NULL AND s_ts < e_ts AND ((latitude IS NULL AND longitude IS NULL) OR
        (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180))"""),
    "event_rules_rejected": with_(P, f"""SELECT {RAW_EVT}, dq_reason FROM (SELECT *, CASE
          WHEN s_ts IS NULL OR e_ts IS NULL OR c_ts IS NULL THEN 'bad_timestamp'
          WHEN s_ts > e_ts THEN 'start_after_end' WHEN s_ts = e_ts THEN 'zero_length'
          WHEN (latitude IS NULL) <> (longitude IS NULL) THEN 'half_null_coordinates'
          WHEN latitude IS NOT NULL AND NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)
            THEN 'coordinates_out_of_range' END AS dq_reason FROM events_typed) WHERE dq_reason IS NOT NULL"""),
    # O6
    "membership_rules_accepted": with_(P, "SELECT * FROM b_memberships WHERE role_title IN ('member', 'admin')"),
    "membership_rules_rejected": with_(P, """SELECT *, 'bad_role' AS dq_reason FROM b_memberships
        WHERE role_title IS NULL OR role_title NOT IN ('member', 'admin')"""),
    # O7 (against the accepted events and memberships)
    "rsvp_rules_accepted": with_(P, f"""SELECT {RAW_RSVP} FROM b_rsvps b WHERE rsvp_status BETWEEN 0 AND 3
        AND EXISTS (SELECT 1 FROM events_acc e JOIN memberships_acc m ON m.group_id = e.team_id
                    WHERE e.event_id = b.event_id AND m.membership_id = b.membership_id)"""),
    "rsvp_rules_rejected": with_(P, f"""SELECT {RAW_RSVP}, CASE
          WHEN rsvp_status IS NULL OR rsvp_status NOT BETWEEN 0 AND 3 THEN 'status_range'
          ELSE 'not_team_member' END AS dq_reason FROM b_rsvps b
        WHERE rsvp_status IS NULL OR rsvp_status NOT BETWEEN 0 AND 3
          OR NOT EXISTS (SELECT 1 FROM events_acc e JOIN memberships_acc m ON m.group_id = e.team_id
                         WHERE e.event_id = b.event_id AND m.membership_id = b.membership_id)"""),
    # O8
    "datekeys": with_(P, f"""SELECT event_id, s_ts AS event_start, {dk('s_ts')} AS event_start_datekey,
        e_ts AS event_end, {dk('e_ts')} AS event_end_datekey, c_ts AS created_at, {dk('c_ts')} AS created_at_datekey
        FROM events_typed WHERE s_ts IS NOT NULL AND e_ts IS NOT NULL AND c_ts IS NOT NULL"""),
    # O9 / O10
    "geo_constant": with_(P, "SELECT event_id, latitude, longitude, county, state FROM events_acc"),
    "geo_nearest": _geo_nearest(500.0),
    "geo_nearest_clustered": _geo_clustered(50.0),
    "geo_within": _geo_within(),
    # O11
    "row_digest": with_(P, f"SELECT event_id, {digest(RAW_EVT.split(', '))} AS hash_key FROM b_events"),
    # O12 / O13
    "scd1_stamped": with_(P, f"""SELECT {RAW_RSVP}, {digest(RAW_RSVP.split(', '))} AS hash_key,
        TIMESTAMP '{AS_OF[0]}' AS system_created_at, TIMESTAMP '{AS_OF[0]}' AS system_updated_at FROM b_rsvps"""),
    "scd2_stamped": with_(P, f"""SELECT {RAW_MEM}, {digest(RAW_MEM.split(', '))} AS hash_key, true AS system_is_active,
        TIMESTAMP '{AS_OF[0]}' AS system_valid_from, cast(NULL AS timestamp) AS system_valid_to FROM b_memberships"""),
    # P1 - P4 (first load)
    "silver_teams": with_(P, "SELECT * FROM teams_acc"),
    "silver_memberships": with_(P, "SELECT * FROM memberships_acc"),
    "silver_events": with_(P, "SELECT * FROM events_acc"),
    "silver_rsvps": with_(P, "SELECT * FROM rsvps_acc"),
    # P3 with looked-up geography
    "silver_events_geo": with_(P + "," + geo_ctes(500.0) + f""",
geo AS (SELECT a.* EXCLUDE (county, state, hash_key, system_is_active, system_valid_from, system_valid_to), r.county, r.state
        FROM events_acc a LEFT JOIN (SELECT * FROM r WHERE rn = 1) r ON a.latitude = r.latitude AND a.longitude = r.longitude)""",
        f"""SELECT {_cols(EVT_COLS)}, {digest(EVT_COLS)} AS hash_key, true AS system_is_active, created_at AS system_valid_from,
        cast(NULL AS timestamp) AS system_valid_to FROM geo"""),
    # E1
    "quarantine_summary": with_(P, """
        SELECT 'teams' AS table_name, dq_reason, count(*) AS rows FROM teams_tag WHERE dq_reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'memberships', dq_reason, count(*) FROM memberships_tag WHERE dq_reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'events', dq_reason, count(*) FROM events_tag WHERE dq_reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'event_rsvps', dq_reason, count(*) FROM rsvps_tag WHERE dq_reason IS NOT NULL GROUP BY 2"""),
}

# History steps: a three-batch scenario over whole tables (FIXTURES.md section 5).
_S = scenario_ctes(False)
QUERIES.update({
    # O14 / O16: teams, batch 2 against the table after batch 1
    "scd1_changed": with_(_S, f"""SELECT {_cols(TEAM_COLS + SCD1_SYS, 'b.')} FROM teams_acc_2 b
        WHERE NOT EXISTS (SELECT 1 FROM teams_s1 t WHERE t.team_id = b.team_id AND t.hash_key = b.hash_key)"""),
    "scd1_upsert": with_(_S, "SELECT * FROM teams_s2_c"),
    # O15: events, batch 2 against the table after batch 1
    "scd2_new_versions": with_(_S, f"SELECT {_cols(EVT_COLS + SCD2_SYS)} FROM evt_s2_c WHERE change IN ('new', 'changed')"),
    "scd2_departed": with_(_S, f"""SELECT {_cols(EVT_COLS + SCD2_SYS)} FROM evt_s1
        WHERE system_is_active AND NOT EXISTS (SELECT 1 FROM b_events_2 r WHERE r.event_id = evt_s1.event_id)
          AND NOT EXISTS (SELECT 1 FROM events_acc_2 a WHERE a.event_id = evt_s1.event_id)"""),
    "scd2_appended": with_(_S, f"SELECT {_cols(EVT_COLS + SCD2_SYS)} FROM evt_s2"),
    # O16: RSVPs, with updates
    "scd1_upsert_rsvps": with_(pipeline_ctes("", None, with_rsvps=False) + "".join(
        "," + pipeline_ctes(f"_{i}", i, teams_parent="teams_acc").strip() for i in (1, 2)) + scd1_step(
            "rsvps_u", "rsvps_acc_1", "rsvps_acc_2", "event_rsvp_id", RSVP_COLS), "SELECT * FROM rsvps_u"),
    # O17 with rows whose flag is missing
    "scd2_null_flag": with_(_S + f""",
mem_n1 AS (SELECT {_cols(MEM_COLS)}, hash_key, CASE WHEN membership_id LIKE '%5' THEN NULL ELSE system_is_active END AS system_is_active,
           system_valid_from, system_valid_to FROM mem_s1)""" + scd2_step("mem_n2_c", "mem_n1", "memberships_acc_2", "b_memberships_2",
                                                                        "membership_id", MEM_COLS, AS_OF[1]), "SELECT * FROM mem_n2_c"),
    # O17 / O18: memberships
    "scd2_closed": with_(_S, f"SELECT {_cols(MEM_COLS + SCD2_SYS)} FROM mem_s2_c WHERE change NOT IN ('new', 'changed')"),
    "scd2_next_snapshot": with_(_S, "SELECT * FROM mem_s3_c"),
    # P5: change counts of the three batches
    "scenario_counts": _scenario_counts(False),
    "scenario_counts_close_rejected": _scenario_counts(True),
})

# E2 - E5: reporting on the silver tables
QUERIES.update({
    "calendar": with_(P + """,
cal_b AS (SELECT min(cast(responded_at AS date)) lo, max(cast(responded_at AS date)) hi FROM rsvps_acc),
cal_d AS (SELECT cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS date FROM cal_b WHERE lo IS NOT NULL)""",
        """SELECT cast(strftime(date, '%Y%m%d') AS int) AS datekey, cast(date AS varchar) AS date,
        cast(year(date) AS int) AS year,
        cast(quarter(date) AS int) AS quarter, cast(month(date) AS int) AS month, cast(weekofyear(date) AS int) AS iso_week,
        cast(isodow(date) AS int) AS iso_day_of_week, cast(day(date) AS int) AS day_of_month,
        cast(cast(date_trunc('month', date) AS date) AS varchar) AS month_start FROM cal_d"""),
    "rsvps_by_quarter": with_(P, """SELECT cast(year(responded_at) AS int) AS year, cast(quarter(responded_at) AS int) AS quarter,
        count(*) AS rows FROM rsvps_acc GROUP BY 1, 2"""),
    "rsvps_last_30_days": with_(P, """SELECT event_rsvp_id, event_id, membership_id, rsvp_status, responded_at,
        responded_at_datekey FROM rsvps_acc
        WHERE responded_at > (SELECT max(responded_at) FROM rsvps_acc) - INTERVAL 30 DAY
          AND responded_at <= (SELECT max(responded_at) FROM rsvps_acc)"""),
    "rsvp_rolling_30d": with_(P + """,
daily AS (SELECT e.team_id, cast(r.responded_at AS date) AS date, count(*) AS rows
          FROM rsvps_acc r JOIN events_acc e ON r.event_id = e.event_id GROUP BY 1, 2)""",
        """SELECT team_id, cast(strftime(date, '%Y%m%d') AS int) AS datekey, rows,
        cast(sum(rows) OVER (PARTITION BY team_id ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)
             AS bigint) AS rows_30d FROM daily"""),
    "rsvp_trend": with_(P, """SELECT e.team_id, cast(r.responded_at_datekey // 100 AS int) AS month_key, r.rsvp_status,
        count(*) AS rsvps, count(DISTINCT r.event_id) AS events
        FROM rsvps_acc r JOIN events_acc e ON r.event_id = e.event_id GROUP BY 1, 2, 3"""),
    "rsvp_history_check": with_(scenario_ctes(False, with_rsvps=True), """SELECT r.event_rsvp_id, r.membership_id,
        r.event_id, EXISTS (SELECT 1 FROM events_acc e JOIN mem_s3 v ON v.group_id = e.team_id
          WHERE e.event_id = r.event_id AND v.membership_id = r.membership_id
            AND v.system_valid_from <= r.responded_at
            AND (v.system_valid_to IS NULL OR r.responded_at < v.system_valid_to)) AS member_at_response
        FROM rsvps_acc r"""),
})


_MEM_VERSION = _cols(MEM_COLS) + ", hash_key, system_valid_from"
_RSVPS_BY_BATCH = "".join(scd1_step(f"rsvps_s{i}_c", "rsvps_s0" if i == 1 else f"rsvps_s{i - 1}", f"rsvps_acc{s}", "event_rsvp_id", RSVP_COLS)
                          + f",\nrsvps_s{i} AS (SELECT {_cols(RSVP_COLS + SCD1_SYS)} FROM rsvps_s{i}_c)" for i, s in ((1, "_1"), (2, "_2"), (3, "")))

QUERIES.update({
    # O15 / O17, any order of arrival: all versions ever seen in time order,
    # one per key and time, each up to the next or the departure
    "scd2_late_versions": with_(_S + f""",
seen AS (SELECT DISTINCT {_MEM_VERSION} FROM (SELECT * FROM memberships_acc UNION ALL SELECT * FROM memberships_acc_1 UNION ALL SELECT * FROM memberships_acc_2)),
stands AS (SELECT * FROM seen s WHERE NOT EXISTS (SELECT 1 FROM seen o WHERE o.membership_id = s.membership_id
           AND o.system_valid_from = s.system_valid_from AND o.hash_key > s.hash_key)),
gone AS (SELECT DISTINCT membership_id FROM (SELECT * FROM memberships_acc UNION ALL SELECT * FROM memberships_acc_2) a
         WHERE NOT EXISTS (SELECT 1 FROM b_memberships_1 r WHERE r.membership_id = a.membership_id)),
ends AS (SELECT s.*, least((SELECT min(o.system_valid_from) FROM stands o WHERE o.membership_id = s.membership_id AND o.system_valid_from > s.system_valid_from),
         (SELECT TIMESTAMP '{AS_OF[2]}' FROM gone g WHERE g.membership_id = s.membership_id)) AS system_valid_to FROM stands s)""",
        f"SELECT {_cols(MEM_COLS)}, hash_key, system_valid_to IS NULL AS system_is_active, system_valid_from, system_valid_to FROM ends"),
    # O14 by digests of key ranges: the same rows as a plain anti-join
    "scd1_changed_ranges": with_(pipeline_ctes("", None, with_rsvps=False) + "".join(
        "," + pipeline_ctes(f"_{i}", i, teams_parent="teams_acc").strip() for i in (1, 2)),
        f"""SELECT {_cols(RSVP_COLS + SCD1_SYS)} FROM rsvps_acc_2 b
        WHERE NOT EXISTS (SELECT 1 FROM rsvps_acc_1 t WHERE t.event_rsvp_id = b.event_rsvp_id AND t.hash_key = b.hash_key)"""),
    # E4 kept up batch by batch: recomputed from the whole tables after each
    "trend_incremental": with_(scenario_ctes(False, with_rsvps=True, every_rsvps=True) + f""",
rsvps_s0 AS (SELECT {_cols(RSVP_COLS + SCD1_SYS)} FROM rsvps_acc WHERE false)""" + _RSVPS_BY_BATCH, " UNION ALL ".join(
        f"""SELECT e.team_id, cast(r.responded_at_datekey // 100 AS int) AS month_key, r.rsvp_status, count(*) AS rsvps,
        count(DISTINCT r.event_id) AS events, {i} AS batch
        FROM rsvps_s{i} r JOIN (SELECT * FROM evt_s{i} WHERE system_is_active) e ON r.event_id = e.event_id GROUP BY 1, 2, 3""" for i in (1, 2, 3))),
    "rsvp_history_asof": QUERIES["rsvp_history_check"],
    # E4 by sketches: exact counts; the sketches must be within their errors
    "trend_rollup": with_(P, """SELECT e.team_id, cast(year(r.responded_at) AS int) AS year, count(*) AS rsvps,
        count(DISTINCT r.membership_id) AS members, true AS members_within, true AS median_within
        FROM rsvps_acc r JOIN events_acc e ON r.event_id = e.event_id GROUP BY 1, 2"""),
    # E1 counted during the write: the same counts
    "quarantine_observed": QUERIES["quarantine_summary"],
    # O16 into a bucketed table: the same rows
    "scd1_upsert_bucketed": QUERIES["scd1_upsert_rsvps"],
})


def refresh_ctes(batches: tuple = (1, 2)) -> str:
    """Consecutive refreshes into one store: each batch's parents are the
    tables as stored by that refresh (teams: all rows; RSVP parents: active)."""
    ctes = f"""
teams_r0 AS (SELECT NULL::varchar AS team_id, NULL::varchar AS team_activity, NULL::varchar AS country_code,
  NULL::timestamp AS created_at, NULL::int AS created_at_datekey, NULL::varchar AS hash_key,
  NULL::timestamp AS system_created_at, NULL::timestamp AS system_updated_at WHERE false),
mem_r0 AS (SELECT NULL::varchar AS membership_id, NULL::varchar AS group_id, NULL::varchar AS role_title,
  NULL::timestamp AS joined_at, NULL::int AS joined_at_datekey, NULL::varchar AS hash_key,
  NULL::boolean AS system_is_active, NULL::timestamp AS system_valid_from, NULL::timestamp AS system_valid_to
  WHERE false),
evt_r0 AS (SELECT NULL::varchar AS event_id, NULL::varchar AS team_id, NULL::timestamp AS event_start,
  NULL::int AS event_start_datekey, NULL::timestamp AS event_end, NULL::int AS event_end_datekey,
  NULL::double AS latitude, NULL::double AS longitude, NULL::timestamp AS created_at, NULL::int AS created_at_datekey,
  NULL::varchar AS county, NULL::varchar AS state, NULL::varchar AS hash_key, NULL::boolean AS system_is_active,
  NULL::timestamp AS system_valid_from, NULL::timestamp AS system_valid_to WHERE false),
rsvp_r0 AS (SELECT NULL::varchar AS event_rsvp_id, NULL::varchar AS event_id, NULL::varchar AS membership_id,
  NULL::bigint AS rsvp_status, NULL::timestamp AS responded_at, NULL::int AS responded_at_datekey,
  NULL::varchar AS hash_key, NULL::timestamp AS system_created_at, NULL::timestamp AS system_updated_at WHERE false)"""
    prev = 0
    for b in batches:
        s = f"_{b}"
        ctes += "," + pipeline_ctes(s, b, parts=("teams",)).strip()
        ctes += scd1_step(f"teams_r{b}_c", f"teams_r{prev}", f"teams_acc{s}", "team_id", TEAM_COLS)
        ctes += f",\nteams_r{b} AS (SELECT {_cols(TEAM_COLS + SCD1_SYS)} FROM teams_r{b}_c)"
        ctes += "," + pipeline_ctes(s, b, teams_parent=f"teams_r{b}", parts=("children",), with_rsvps=False).strip()
        ctes += scd2_step(f"mem_r{b}_c", f"mem_r{prev}", f"memberships_acc{s}", f"b_memberships{s}",
                          "membership_id", MEM_COLS, AS_OF[b - 1])
        ctes += f",\nmem_r{b} AS (SELECT {_cols(MEM_COLS + SCD2_SYS)} FROM mem_r{b}_c)"
        ctes += scd2_step(f"evt_r{b}_c", f"evt_r{prev}", f"events_acc{s}", f"b_events{s}", "event_id", EVT_COLS,
                          AS_OF[b - 1])
        ctes += f",\nevt_r{b} AS (SELECT {_cols(EVT_COLS + SCD2_SYS)} FROM evt_r{b}_c)"
        rs = pipeline_ctes(f"_r{b}", b, parts=("children",), with_rsvps=True,
                           events_parent=f"(SELECT * FROM evt_r{b} WHERE system_is_active)",
                           members_parent=f"(SELECT * FROM mem_r{b} WHERE system_is_active)")
        # only the RSVP block of that chunk is needed
        ctes += "," + rs[rs.index("b_rsvps"):].strip()
        ctes += scd1_step(f"rsvp_r{b}_c", f"rsvp_r{prev}", f"rsvps_acc_r{b}", "event_rsvp_id", RSVP_COLS)
        ctes += f",\nrsvp_r{b} AS (SELECT {_cols(RSVP_COLS + SCD1_SYS)} FROM rsvp_r{b}_c)"
        prev = b
    return ctes


_R = refresh_ctes((1, 2))
QUERIES.update({
    "refresh_teams": with_(_R, f"SELECT {_cols(TEAM_COLS + SCD1_SYS)} FROM teams_r2"),
    "refresh_quarantine": with_(_R, _quarantined("_2", "_r2")),
    "refresh_memberships": with_(_R, "SELECT * FROM mem_r2"),
    "refresh_events": with_(_R, "SELECT * FROM evt_r2"),
    "refresh_rsvps": with_(_R, "SELECT * FROM rsvp_r2"),
})

# A second refresh over unchanged data changes nothing: the stored tables
# equal the first load.
QUERIES.update({
    "refresh_rerun_quarantine": with_(P, _quarantined("", "")),
    "refresh_rerun_teams": with_(P, "SELECT * FROM teams_acc"),
    "refresh_rerun_memberships": with_(P, "SELECT * FROM memberships_acc"),
    "refresh_rerun_events": with_(P, "SELECT * FROM events_acc"),
    "refresh_rerun_rsvps": with_(P, "SELECT * FROM rsvps_acc"),
})
