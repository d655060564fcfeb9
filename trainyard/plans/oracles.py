"""DuckDB SQL for the driver's correctness check (one per query name).

Written independently of the Spark code, over the raw driver views.
"""

DEPARTURE = "2024-01-01 00:00:00"
HOP_SOURCE = "Berlin Hub 1"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Names that a path may have, and the station they mean.
ALIASES = """
Berlin Zoo > Berlin Zoologischer Garten
Zoo > Berlin Zoologischer Garten
Berlin Hauptbahnhof > Berlin Hbf
Berlin Hbf (S-Bahn) > Berlin Hbf
Berlin Yorckstr.(S1) > Berlin Yorckstraße
Berlin Yorckstr.(S2) > Berlin Yorckstraße
Berlin Südkreuz (Bus) > Berlin Südkreuz
Berlin Wittenau (Wilhelmsruher Damm) > Berlin Wittenau
Bernau(b Berlin) > Bernau
Borgsdorf, Hohen Neuendorf > Borgsdorf
Birkenwerder Hauptstraße > Birkenwerder
Buch, Berlin > Berlin Buch
Karow Bahnhof, Berlin > Berlin Karow
Pankow-Heinersdorf, Berlin > Berlin Pankow-Heinersdorf
Köpenick/Parrisiusstr., Berlin > Berlin Köpenick
Blankenburg, Berlin > Berlin Blankenburg
"""


def _alias_values() -> str:
    pairs = [line.split(" > ") for line in ALIASES.strip().splitlines()]
    return ", ".join(f"({_q(k)}, {_q(v)})" for k, v in pairs)


def norm_station(x: str) -> str:
    """Path-station normaliser as a SQL expression over ``x`` (ASCII
    blanks only in the test data); alias lookup via a scalar subquery."""
    y = x
    for suf in [" (S)", " (U)", " (S+U)", "(S)", "(U)", "(S+U)"]:
        y = f"replace({y}, {_q(suf)}, '')"
    y = (f"(CASE WHEN starts_with({y}, 'Berlin-') THEN 'Berlin ' || "
         f"substr({y}, 8) ELSE {y} END)")
    return (f"trim(coalesce((SELECT a.v FROM (VALUES {_alias_values()}) "
            f"a(k, v) WHERE a.k = {y}), {y}))")


def round2(s: str, n: str) -> str:
    """Exact half-away-from-zero rounding of s/n to 2 decimals, double."""
    return (f"CAST(sign({s}) * ((abs({s}) * 200 + {n}) // (2 * {n})) "
            f"AS DOUBLE) / 100.0")


def norm_name(x: str) -> str:
    return (f"regexp_replace(replace(lower(trim({x})), '_', ' '), "
            f"'\\s+', ' ', 'g')")


PATH_NAMES = """'Berlin Zoo', 'Zoo', 'Berlin Hauptbahnhof',
  'Berlin-Hbf (S-Bahn)', 'Berlin Yorckstr.(S1)', 'Berlin-Yorckstr.(S2) (S+U)',
  'Berlin Südkreuz (Bus)', 'Berlin Wittenau (Wilhelmsruher Damm) (U)',
  'Bernau(b Berlin)', 'Borgsdorf, Hohen Neuendorf',
  'Birkenwerder Hauptstraße (S)', 'Buch (S), Berlin', 'Karow Bahnhof, Berlin',
  'Pankow-Heinersdorf, Berlin', 'Köpenick/Parrisiusstr., Berlin',
  'Blankenburg, Berlin', ' Zoo', 'Berlin-Zoo '"""

TK = "CAST(strftime({}, '%Y%m%d%H%M') AS BIGINT)"

def in_week(day, hours, minutes):
    return (f"(TIMESTAMP '2025-09-01 00:00:00' + to_days(CAST(date_diff("
            f"'day', DATE '1995-01-01', CAST({day} AS DATE)) % 7 AS INTEGER))"
            f" + to_hours(CAST({hours} AS BIGINT))"
            f" + to_minutes(CAST({minutes} AS BIGINT)))")


DEP = in_week("o_orderdate", "o_orderkey % 24", "o_custkey % 60")
SHIP = in_week("l_shipdate", "l_orderkey % 24", "l_linenumber * 7")

PLAN_RAW = f"""
plan_raw AS (
  SELECT 'S' || CAST(o_custkey % 40 AS VARCHAR) AS station_name,
         CAST(o_orderkey AS VARCHAR) AS stop_id,
         o_orderpriority AS train_category,
         CAST(o_custkey AS VARCHAR) AS train_number,
         CASE WHEN o_orderstatus <> 'O' THEN {DEP} - INTERVAL 7 MINUTE END
           AS planned_arrival,
         substr(o_orderpriority, 1, 1) AS platform_arrival,
         CASE WHEN o_orderstatus <> 'F' THEN {DEP} END AS planned_departure,
         substr(o_orderpriority, 1, 1) AS platform_departure
  FROM orders)"""

CHANGE_RAW = f"""
change_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS stop_id,
    CASE WHEN l_discount >= 0.03 THEN {SHIP} END AS actual_arrival,
    CAST(l_linenumber AS VARCHAR) AS actual_platform_arrival,
    CASE WHEN l_returnflag = 'R' THEN 'c' WHEN l_returnflag = 'A' THEN 'a'
         END AS arrival_status,
    CASE WHEN l_tax >= 0.02 THEN {SHIP}
         + to_minutes(CAST(l_linenumber * 4 AS BIGINT)) END
         AS actual_departure,
    CAST(l_suppkey % 10 AS VARCHAR) AS actual_platform_departure,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'c'
         WHEN l_linestatus = 'F' THEN 'p' END AS departure_status,
    'changes/' || strftime({SHIP}, '%y%m%d%H') || '00/'
         || CAST(l_suppkey AS VARCHAR) || '.xml' AS source_file,
    strftime({SHIP}, '%y%m%d%H') || '00' AS update_timestamp
  FROM lineitem)"""

LATEST = """
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY
      update_timestamp DESC NULLS LAST, source_file DESC NULLS LAST,
      actual_arrival DESC NULLS LAST, actual_platform_arrival DESC NULLS LAST,
      arrival_status DESC NULLS LAST, actual_departure DESC NULLS LAST,
      actual_platform_departure DESC NULLS LAST,
      departure_status DESC NULLS LAST) AS rn
    FROM change_raw) WHERE rn = 1)"""


def _clamp(a: str, p: str) -> str:
    d = f"((epoch({a}) - epoch({p})) / 60.0)"
    return (f"CASE WHEN {a} IS NULL THEN 0.0 WHEN {d} < 0 THEN 0.0 "
            f"ELSE {d} END")


MOVEMENTS = f"""
movements AS (
  SELECT p.stop_id, p.station_name, p.train_category, p.train_number,
    p.planned_arrival, u.actual_arrival,
    {_clamp('u.actual_arrival', 'p.planned_arrival')} AS arrival_delay_minutes,
    p.planned_departure, u.actual_departure,
    {_clamp('u.actual_departure', 'p.planned_departure')}
      AS departure_delay_minutes,
    (coalesce(u.arrival_status = 'c', false)
      OR coalesce(u.departure_status = 'c', false)) AS is_cancelled,
    CAST(coalesce(p.planned_departure, p.planned_arrival) AS DATE) AS date,
    CAST(hour(coalesce(p.planned_departure, p.planned_arrival)) AS INTEGER)
      AS hour
  FROM plan_raw p LEFT JOIN latest u USING (stop_id))"""

LAKE = f"WITH {PLAN_RAW}, {CHANGE_RAW}, {LATEST}, {MOVEMENTS}"

LI_KEYS = f"""
li AS (
  SELECT *,
    {TK.format("date_trunc('month', l_shipdate)")} AS snapshot_time_key,
    l_suppkey AS station_key,
    l_returnflag || l_linestatus AS stop_id,
    CASE WHEN l_linenumber % 2 = 1 THEN 'A' ELSE 'D' END AS event_type,
    round(l_extendedprice * 100) AS sp, round(l_quantity) AS q
  FROM lineitem)"""

PLAN_ROWS = f"""
plan_rows AS (
  SELECT 0 AS phase, l_orderkey, l_linenumber, l_partkey, sp, q,
    snapshot_time_key, station_key, stop_id, event_type,
    CASE WHEN l_quantity < 5 THEN 'UNK'
         ELSE 'T' || CAST(l_linenumber AS VARCHAR) END AS category,
    CASE WHEN l_quantity < 5 THEN 'UNK'
         ELSE CAST(l_partkey AS VARCHAR) END AS train_number,
    '' AS owner, '' AS trip_type, '' AS filter_flags,
    CASE WHEN l_discount <> 0 THEN
      {TK.format("l_shipdate + to_hours(CAST(l_linenumber AS BIGINT))")}
      END AS planned_time_key,
    CAST(NULL AS BIGINT) AS changed_time_key,
    CAST(NULL AS VARCHAR) AS event_status,
    CASE WHEN l_tax <> 0 THEN CAST(l_linenumber AS VARCHAR) END
      AS planned_platform,
    CAST(NULL AS VARCHAR) AS changed_platform,
    CASE WHEN l_quantity <= 40 THEN 'L' || CAST(l_suppkey % 5 AS VARCHAR)
      END AS line,
    CASE WHEN l_returnflag <> 'R' THEN 'P' || CAST(l_partkey AS VARCHAR)
      END AS planned_path,
    CAST(NULL AS INTEGER) AS delay_minutes, false AS is_cancelled
  FROM li)"""

CHANGE_ROWS = f"""
change_rows AS (
  SELECT 1 AS phase, l_orderkey, l_linenumber, l_partkey, sp, q,
    snapshot_time_key, station_key, stop_id, event_type,
    CASE WHEN l_linestatus = 'O' THEN 'UNK'
         ELSE 'T' || CAST(l_linenumber + 1 AS VARCHAR) END AS category,
    CASE WHEN l_linestatus = 'O' THEN 'UNK'
         ELSE CAST(l_partkey AS VARCHAR) END AS train_number,
    CASE WHEN l_linestatus = 'O' THEN '' ELSE 'o' END AS owner,
    '' AS trip_type, '' AS filter_flags,
    CASE WHEN l_quantity >= 10 THEN {TK.format("l_shipdate")} END
      AS planned_time_key,
    CASE WHEN l_discount <= 0.08 THEN
      {TK.format("l_shipdate + to_minutes(CAST(l_linenumber * 13 AS BIGINT))")}
      END AS changed_time_key,
    CASE WHEN l_returnflag = 'R' THEN 'c' WHEN l_returnflag = 'A' THEN 'a'
      END AS event_status,
    CASE WHEN l_quantity >= 25 THEN 'X' || CAST(l_linenumber AS VARCHAR)
      END AS planned_platform,
    CASE WHEN l_tax <= 0.05 THEN CAST(l_suppkey % 9 AS VARCHAR) END
      AS changed_platform,
    CASE WHEN l_discount >= 0.02 THEN 'CL' || CAST(l_linenumber AS VARCHAR)
      END AS line,
    CASE WHEN l_linenumber <> 3 THEN 'CP' || CAST(l_orderkey AS VARCHAR)
      END AS planned_path,
    CASE WHEN l_quantity > 45 THEN CAST(l_linenumber AS INTEGER)
         WHEN l_quantity >= 10 AND l_discount <= 0.08
         THEN CAST(l_linenumber * 13 AS INTEGER) END AS delay_minutes,
    coalesce(l_returnflag = 'R', false) AS is_cancelled
  FROM li)"""


def _last(c, cond=None):
    f = f"{c} IS NOT NULL" + (f" AND {cond}" if cond else "")
    return f"arg_max({c}, rn) FILTER (WHERE {f})"


def _first(c, cond):
    return f"arg_min({c}, rn) FILTER (WHERE {c} IS NOT NULL AND {cond})"


UNK = ("{'category': 'UNK', 'train_number': 'UNK', 'owner': '', "
       "'trip_type': '', 'filter_flags': ''}")
TRAIN = ("{'category': category, 'train_number': train_number, "
         "'owner': owner, 'trip_type': trip_type, "
         "'filter_flags': filter_flags}")

FACT = f"""
ev_rows AS (SELECT * FROM plan_rows UNION ALL SELECT * FROM change_rows),
ranked AS (
  SELECT *, {TRAIN} AS train, row_number() OVER (
    PARTITION BY snapshot_time_key, station_key, stop_id, event_type
    ORDER BY phase, l_orderkey, l_linenumber, l_partkey, sp, q) AS rn
  FROM ev_rows),
fact AS (
  SELECT snapshot_time_key, station_key, stop_id, event_type,
    coalesce({_last('planned_time_key', 'phase = 0')},
             {_first('planned_time_key', 'phase = 1')}) AS planned_time_key,
    {_last('changed_time_key')} AS changed_time_key,
    {_last('event_status')} AS event_status,
    coalesce({_last('planned_platform', 'phase = 0')},
             {_first('planned_platform', 'phase = 1')}) AS planned_platform,
    {_last('changed_platform')} AS changed_platform,
    {_last('line')} AS line,
    {_last('planned_path')} AS planned_path,
    {_last('delay_minutes')} AS delay_minutes,
    bool_or(is_cancelled) AS is_cancelled,
    coalesce(arg_max(train, rn) FILTER (WHERE phase = 0 OR train <> {UNK}),
             {UNK}) AS train
  FROM ranked GROUP BY ALL)"""

STAR = f"WITH {LI_KEYS}, {PLAN_ROWS}, {CHANGE_ROWS}, {FACT}"

FACT_SELECT = """
SELECT snapshot_time_key, station_key, stop_id, event_type, planned_time_key,
  changed_time_key, event_status, planned_platform, changed_platform, line,
  planned_path, delay_minutes, is_cancelled, train.category AS category,
  train.train_number AS train_number, train.owner AS owner,
  train.trip_type AS trip_type, train.filter_flags AS filter_flags
FROM fact"""

# The XML load: documents of an order are in the snapshot folder of its key
# modulo four; stations with k % 13 = 12 are not in the station list.
SNAP = "(202509010800 + 15 * CAST({} % 4 AS BIGINT))"

XML_STAR = f"""WITH {PLAN_RAW},
  pk AS (
    SELECT *, {SNAP.format('CAST(stop_id AS BIGINT)')} AS snap,
      8000000 + CAST(substr(station_name, 2) AS INTEGER) AS station_key,
      CAST(substr(station_name, 2) AS INTEGER) % 13 <> 12 AS known
    FROM plan_raw),
  prow AS (
    SELECT snap, station_key, stop_id, 'A' AS event_type,
      {TK.format('planned_arrival')} AS planned_time_key,
      platform_arrival AS planned_platform, CAST(NULL AS VARCHAR) AS line,
      CAST(NULL AS VARCHAR) AS planned_path,
      train_category AS category, train_number
    FROM pk WHERE known AND planned_arrival IS NOT NULL
    UNION ALL
    SELECT snap, station_key, stop_id, 'D',
      {TK.format('planned_departure')}, platform_departure,
      'L' || right(train_number, 1), station_name || '|S0',
      train_category, train_number
    FROM pk WHERE known AND planned_departure IS NOT NULL),
  lines AS (
    SELECT *, {SNAP.format('l_orderkey')} AS snap,
      8000000 + o_custkey % 40 AS station_key,
      CAST(l_orderkey AS VARCHAR) AS stop_id,
      CAST('20' || strftime(l_shipdate + to_minutes(
        CAST(l_linenumber * 7 AS BIGINT)), '%y%m%d%H%M') AS BIGINT) AS ck,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
        l_shipdate, l_returnflag, l_quantity) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_custkey % 40 % 13 <> 12),
  crow AS (
    SELECT snap, station_key, stop_id, 'A' AS event_type, ck, rn,
      CASE WHEN l_returnflag = 'R' THEN 'c' END AS event_status,
      CAST(NULL AS INTEGER) AS delay_minutes FROM lines
    UNION ALL
    SELECT snap, station_key, stop_id, 'D', ck, rn, NULL,
      CASE WHEN l_quantity > 25 THEN CAST(l_linenumber AS INTEGER) END
    FROM lines),
  ch AS (
    SELECT snap, station_key, stop_id, event_type,
      arg_max(ck, rn) FILTER (WHERE ck IS NOT NULL) AS changed_time_key,
      arg_max(event_status, rn) FILTER (WHERE event_status IS NOT NULL)
        AS event_status,
      arg_max(delay_minutes, rn) FILTER (WHERE delay_minutes IS NOT NULL)
        AS delay_minutes,
      coalesce(bool_or(event_status = 'c'), false) AS is_cancelled
    FROM crow GROUP BY ALL),
  folded AS (
    SELECT CAST(coalesce(p.snap, c.snap) AS BIGINT) AS snapshot_time_key,
      CAST(coalesce(p.station_key, c.station_key) AS BIGINT) AS station_key,
      coalesce(p.stop_id, c.stop_id) AS stop_id,
      coalesce(p.event_type, c.event_type) AS event_type,
      p.planned_time_key, c.changed_time_key, c.event_status,
      p.planned_platform, p.line, p.planned_path, c.delay_minutes,
      coalesce(c.is_cancelled, false) AS is_cancelled,
      coalesce(p.category, 'UNK') AS category,
      coalesce(p.train_number, 'UNK') AS train_number
    FROM prow p FULL OUTER JOIN ch c
      ON p.snap = c.snap AND p.station_key = c.station_key
     AND p.stop_id = c.stop_id AND p.event_type = c.event_type)"""

PART_STOPS = """
stops AS (
  SELECT l_orderkey, printf('Part %07d', l_partkey) AS station,
         min(l_linenumber) AS line
  FROM lineitem GROUP BY 1, 2)"""


def hop_levels(n: int) -> str:
    """Breadth-first levels 0 to n from every requested source, each with the
    least path to a node; no shortest path there is longer."""
    out = f"""{PART_STOPS},
  ranked_stops AS (
    SELECT l_orderkey, station, lead(station) OVER (
      PARTITION BY l_orderkey ORDER BY line, station) AS dst FROM stops),
  part_edges AS (SELECT DISTINCT station AS src, dst FROM ranked_stops
                 WHERE dst IS NOT NULL),
  part_nodes AS (SELECT DISTINCT station AS node FROM stops),
  hop_req AS (
    SELECT c_custkey AS request_id,
      CASE WHEN c_custkey % 97 = 0 THEN 'Nowhere' ELSE
        printf('Part %07d', c_custkey * 7 % 300 + 1) END AS source,
      CASE WHEN c_custkey % 89 = 0 THEN '%' ELSE
        printf('Part %07d', c_custkey * 131 % 2500 + 1) END AS target
    FROM customer),
  level0 AS MATERIALIZED (
    SELECT DISTINCT source AS src, source AS node, [source] AS path
    FROM hop_req WHERE source IN (SELECT node FROM part_nodes))"""
    for i in range(1, n + 1):
        seen = " UNION ALL ".join(f"SELECT src, node FROM level{j}"
                                  for j in range(i))
        out += f""",
  level{i} AS MATERIALIZED (
    SELECT s.src, s.node, min(s.path) AS path FROM (
      SELECT l.src, e.dst AS node, list_append(l.path, e.dst) AS path
      FROM level{i - 1} l JOIN part_edges e ON e.src = l.node) s
    ANTI JOIN ({seen}) o ON o.src = s.src AND o.node = s.node
    GROUP BY s.src, s.node)"""
    return out + """,
  reached AS (""" + " UNION ALL ".join(
        f"SELECT * FROM level{i}" for i in range(n + 1)) + ")"


CUSTOMER_ENTRIES = """
cust AS (
  SELECT c_custkey,
    CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN 'Berlin_' || c_name
         WHEN 2 THEN ' berlin   ' || c_mktsegment
         ELSE 'BERLIN' || c_mktsegment END AS name,
    c_mktsegment = 'BUILDING' AS second_main,
    c_acctbal, c_nationkey
  FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'),
recs AS (
  SELECT c_custkey, name,
    CASE WHEN second_main THEN 9000000 + c_nationkey
         ELSE 8000000 + c_custkey // 3 END AS eva,
    CASE WHEN second_main THEN CAST(c_nationkey AS DOUBLE)
         WHEN c_acctbal > 5000 THEN NULL ELSE c_acctbal / 100.0 END AS lat,
    CASE WHEN second_main THEN c_acctbal / 100.0
         WHEN c_acctbal > 5000 THEN NULL
         ELSE CAST(c_nationkey AS DOUBLE) END AS lon
  FROM cust)"""

PATHS = """
paths AS (
  SELECT DISTINCT concat_ws('|',
    'Berlin-Hub ' || CAST(l_linenumber AS VARCHAR),
    'Stop ' || CAST(CAST(round(l_quantity) AS INTEGER) AS VARCHAR) || ' (S)',
    CASE WHEN l_returnflag = 'R' THEN '(S)' WHEN l_returnflag = 'A' THEN ' '
         ELSE 'Stop ' || CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR)
         END,
    'Stop ' || CAST(CAST(round(l_discount * 100 + 40) AS INTEGER) AS VARCHAR)
  ) AS planned_path FROM lineitem)"""

GRAPH = f"""
{PATHS},
seg0 AS (
  SELECT planned_path, list_filter(string_split(planned_path, '|'),
                                   lambda x: trim(x) <> '') AS raw
  FROM paths),
segx AS (SELECT planned_path, unnest(raw) AS x,
                unnest(range(1, len(raw) + 1)) AS i FROM seg0),
segn AS (SELECT planned_path, i, {norm_station('x')} AS s FROM segx),
nodes AS (SELECT DISTINCT s AS station FROM segn WHERE s <> ''),
edges AS (
  SELECT DISTINCT a.s AS src, b.s AS dst
  FROM segn a JOIN segn b
    ON a.planned_path = b.planned_path AND b.i = a.i + 1
  WHERE a.s <> '' AND b.s <> '' AND a.s <> b.s)"""

EVENT_CONN = """
tev AS (
  SELECT user_id AS train_key,
    'S' || CAST(CAST(floor(CAST(json_extract_string(props, '$.k') AS INTEGER)
                / 3) AS BIGINT) AS VARCHAR) AS station,
    CASE WHEN event_type IN ('click', 'view') THEN 'D' ELSE 'A' END
      AS event_type,
    ts, CAST(event_id AS VARCHAR) AS stop_id, CAST(ts AS DATE) AS date
  FROM events WHERE event_type <> 'error'),
nx AS (
  SELECT *, lead(event_type) OVER w AS n_et, lead(station) OVER w AS n_st,
    lead(ts) OVER w AS n_ts
  FROM tev WINDOW w AS (PARTITION BY train_key, date
                        ORDER BY ts, event_type, station, stop_id)),
conn AS (
  SELECT station AS from_station, n_st AS to_station, ts AS departure_time,
    n_ts AS arrival_time, train_key AS train_id, date
  FROM nx WHERE event_type = 'D' AND n_et = 'A')"""

SUPPLIER_DIM = """
sdim AS (SELECT s_suppkey AS station_key, s_suppkey AS eva,
                s_name AS station_name, s_acctbal / 100.0 AS lat,
                CAST(s_nationkey AS DOUBLE) AS lon FROM supplier)"""

PART_DIM = """
pdim AS (SELECT p_partkey AS eva, p_name || ' ' || p_partkey AS station_name,
                p_size / 1.0 AS lat, p_retailprice AS lon FROM part)"""

STAMP_TEXT = """CASE WHEN o_orderstatus = 'F'
    THEN strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)),
                  '%y%m%d%H%M')
    WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%y%m') || '321200'
    ELSE ' ' || substr(o_orderpriority, 1, 9) END"""


def _parse(s):
    return (f"CASE WHEN regexp_full_match({s}, '[0-9]{{10}}') THEN "
            f"try_strptime('20' || {s}, '%Y%m%d%H%M') END")


DELAY_IN = """
din AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate
         + to_hours(CAST(o_orderkey % 24 AS BIGINT)) END AS pt,
    CASE WHEN l_discount >= 0.03 THEN l_shipdate
         + to_minutes(CAST(l_linenumber * 37 AS BIGINT)) END AS ct,
    CASE WHEN l_quantity > 45 THEN CAST(l_linenumber AS VARCHAR)
         WHEN l_quantity < 3 THEN '--5' WHEN l_quantity < 4 THEN ' 5' END
      AS dc
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EVENT_DOCS = f"""
edocs AS (
  SELECT event_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    strftime(ts, '%y%m%d%H') || '00' AS snapshot,
    value > 19.0 AS bad
  FROM events),
nalias AS (
  SELECT {norm_name("'Stop ' || CAST(n_nationkey AS VARCHAR)")} AS alias,
         7000000 + n_nationkey AS eva FROM nation
  UNION ALL
  SELECT 'berlin ' || {norm_name("'Stop ' || CAST(n_nationkey AS VARCHAR)")},
         7000000 + n_nationkey FROM nation),
resolved AS (
  SELECT d.event_id, CAST(a.eva AS BIGINT) AS station_key, d.snapshot
  FROM edocs d JOIN nalias a
    ON {norm_name("'STOP_' || CAST(d.k AS VARCHAR)")} = a.alias
  WHERE NOT d.bad)"""

ORACLE: dict[str, str] = {
    "latest_update": f"WITH {CHANGE_RAW}, {LATEST} SELECT * FROM latest",
    "merge_left_delay": f"{LAKE} SELECT * FROM movements",
    "partitioned_write": f"{LAKE} SELECT * FROM movements",
    "q32_daily_mean": f"""{LAKE},
      d AS (SELECT station_name, date, avg(arrival_delay_minutes) AS m
            FROM movements WHERE NOT is_cancelled GROUP BY 1, 2)
      SELECT station_name, round(avg(m), 6) AS final_avg, count(*) AS days
      FROM d GROUP BY 1""",
    "q33_peak_hours": f"""{LAKE},
      d AS (SELECT station_name, date, count(*) AS c FROM movements
            WHERE planned_departure IS NOT NULL AND hour IN (7, 8, 17, 18)
            GROUP BY 1, 2)
      SELECT station_name,
        {round2('CAST(sum(c) AS BIGINT)', 'count(*)')} AS avg_peak_departures,
        count(c) AS days_observed
      FROM d GROUP BY 1""",
    "fact_upsert": f"{STAR} {FACT_SELECT}",
    "incremental_load": f"{STAR} {FACT_SELECT}",
    "q21_station_lookup": f"""WITH {SUPPLIER_DIM},
      req AS (SELECT s_suppkey AS request_id,
                CASE WHEN s_suppkey % 2 = 0 THEN lower(substr(s_name, 7, 6))
                     ELSE substr(s_name, 15, 3) END AS text FROM supplier),
      hits AS (SELECT r.request_id, d.* FROM req r JOIN sdim d
               ON contains(lower(d.station_name), lower(r.text)))
      SELECT request_id, arg_min(station_name, (station_name, eva))
          AS station_name,
        arg_min(lat, (station_name, eva)) AS lat,
        arg_min(lon, (station_name, eva)) AS lon,
        arg_min(eva, (station_name, eva)) AS identifier
      FROM hits GROUP BY request_id""",
    "q22_nearest": f"""WITH {SUPPLIER_DIM},
      pts AS (SELECT c_custkey AS request_id, c_acctbal / 100.0 AS lat,
                CAST(c_nationkey AS DOUBLE) AS lon FROM customer),
      d AS (SELECT p.request_id, s.station_name,
              (s.lat - p.lat) ^ 2 + (s.lon - p.lon) ^ 2 AS d2
            FROM pts p, sdim s
            WHERE s.lat IS NOT NULL AND s.lon IS NOT NULL)
      SELECT request_id, arg_min(station_name, (d2, station_name))
        AS station_name FROM d GROUP BY request_id""",
    "q23_cancelled_distinct": f"""{STAR}
      SELECT snapshot_time_key,
        count(DISTINCT (station_key, stop_id)) AS cancelled_trains
      FROM fact WHERE is_cancelled GROUP BY 1""",
    "q24_avg_delay": f"""{STAR}, {SUPPLIER_DIM},
      per_key AS (
        SELECT station_key, sum(delay_minutes) AS minutes,
          count(delay_minutes) AS events
        FROM fact WHERE event_type = 'D' AND NOT is_cancelled
        GROUP BY station_key HAVING count(delay_minutes) > 0),
      per_name AS (
        SELECT n.station_name, CAST(sum(minutes) AS BIGINT) AS minutes,
          CAST(sum(events) AS BIGINT) AS events
        FROM per_key JOIN sdim n USING (station_key)
        WHERE contains(lower(n.station_name), 'supplier')
        GROUP BY n.station_name)
      SELECT station_name, {round2('minutes', 'events')}
          AS avg_delay_minutes, events AS num_events_used
      FROM per_name""",
    "dim_time": f"""WITH t AS (
        SELECT o_orderdate AS ts FROM orders UNION
        SELECT l_shipdate FROM lineitem UNION
        SELECT date_trunc('minute', ts) FROM events)
      SELECT {TK.format('ts')} AS time_key, ts, CAST(ts AS DATE) AS date,
        CAST(hour(ts) AS SMALLINT) AS hour,
        CAST(minute(ts) AS SMALLINT) AS minute,
        CAST(isodow(ts) AS SMALLINT) AS dow, isodow(ts) >= 6 AS is_weekend
      FROM t WHERE ts IS NOT NULL""",
    "dim_train": """
      SELECT DISTINCT * FROM (
        SELECT CASE WHEN p_size < 5 OR p_brand IS NULL OR p_brand = ''
                    THEN 'UNK' ELSE p_brand END AS category,
          coalesce(nullif(p_type, ''), 'UNK') AS train_number,
          CAST(p_size AS VARCHAR) AS owner,
          CASE WHEN p_size > 25 THEN 'p' ELSE '' END AS trip_type,
          '' AS filter_flags FROM part
        UNION ALL SELECT 'UNK', 'UNK', '', '', '')""",
    "unknown_member": """
      WITH t AS (SELECT DISTINCT * FROM (
        SELECT CASE WHEN p_size < 5 OR p_brand IS NULL OR p_brand = ''
                    THEN 'UNK' ELSE p_brand END AS category,
          coalesce(nullif(p_type, ''), 'UNK') AS train_number,
          CAST(p_size AS VARCHAR) AS owner,
          CASE WHEN p_size > 25 THEN 'p' ELSE '' END AS trip_type,
          '' AS filter_flags FROM part
        UNION ALL SELECT 'UNK', 'UNK', '', '', ''))
      SELECT owner, trip_type, filter_flags, count(*) AS n FROM t
      WHERE category = 'UNK' AND train_number = 'UNK' GROUP BY ALL""",
    "dim_station_last_wins": f"""WITH {CUSTOMER_ENTRIES}
      SELECT eva AS station_key, eva, w.n AS station_name, w.la AS lat,
        w.lo AS lon
      FROM (SELECT eva, arg_max({{'n': name, 'la': lat, 'lo': lon}},
                                c_custkey) AS w
            FROM recs GROUP BY eva)""",
    "station_alias": f"""WITH {CUSTOMER_ENTRIES},
      n AS (SELECT c_custkey, eva, {norm_name('name')} AS n FROM recs),
      a AS (
        SELECT n AS alias, eva, c_custkey, 0 AS ord FROM n
        UNION ALL SELECT substr(n, 8), eva, c_custkey, 1 FROM n
          WHERE starts_with(n, 'berlin ')
        UNION ALL SELECT 'berlin ' || n, eva, c_custkey, 2 FROM n
          WHERE NOT starts_with(n, 'berlin'))
      SELECT alias, arg_max(eva, (c_custkey, ord)) AS eva
      FROM a GROUP BY alias""",
    "json_explode": f"""WITH {CUSTOMER_ENTRIES}
      SELECT eva, name, lat, lon FROM recs""",
    "station_resolve": f"""WITH {EVENT_DOCS}
      SELECT event_id, station_key FROM resolved""",
    "load_stats": f"""WITH {EVENT_DOCS}
      SELECT (SELECT count(DISTINCT snapshot) FROM edocs) AS snapshots,
        (SELECT count(*) FROM edocs) AS xml_files,
        (SELECT count(*) FROM resolved) AS event_rows,
        (SELECT count(*) FROM edocs WHERE NOT bad) -
          (SELECT count(*) FROM resolved) AS skipped_station,
        (SELECT count(*) FROM edocs WHERE bad) AS bad_xml""",
    "event_unpivot": """
      SELECT l_orderkey, l_linenumber, 'A' AS event_type,
        strftime(l_shipdate, '%y%m%d%H%M') AS pt,
        CAST(l_linenumber AS VARCHAR) AS pp
      FROM lineitem WHERE l_discount > 0.02
      UNION ALL
      SELECT l_orderkey, l_linenumber, 'D',
        strftime(l_shipdate + INTERVAL 2 HOUR, '%y%m%d%H%M'),
        CAST(NULL AS VARCHAR)
      FROM lineitem WHERE l_tax > 0.01""",
    "check_unique": """
      SELECT l_orderkey, l_linenumber, count(*) AS n, 'unique' AS rule
      FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_fk": """
      SELECT o_orderkey, o_custkey, 'fk customer' AS rule FROM orders
      WHERE o_custkey IS NOT NULL
        AND o_custkey NOT IN (SELECT c_custkey FROM customer
                              WHERE c_custkey IS NOT NULL)""",
    "check_domain": """
      SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
        l_discount, 'domain' AS rule FROM lineitem
      WHERE NOT coalesce(l_returnflag IN ('A', 'N')
        AND l_linestatus IN ('O', 'F')
        AND l_discount BETWEEN 0.0 AND 0.09, false)""",
    "parse_stamp": f"""WITH s AS (
        SELECT o_orderkey, {STAMP_TEXT} AS s FROM orders),
      p AS (SELECT o_orderkey, s, {_parse('s')} AS ts FROM s)
      SELECT o_orderkey, s, ts, {TK.format('ts')} AS time_key,
        CAST(ts AS DATE) AS date, CAST(hour(ts) AS SMALLINT) AS hour,
        CAST(minute(ts) AS SMALLINT) AS minute,
        CAST(isodow(ts) AS SMALLINT) AS dow, isodow(ts) >= 6 AS is_weekend
      FROM p""",
    "signed_delay": f"""WITH {DELAY_IN}
      SELECT l_orderkey, l_linenumber,
        CASE WHEN regexp_full_match(dc, '-?[0-9]+') THEN CAST(dc AS INTEGER)
             ELSE CAST(round(date_diff('second', pt, ct) / 60.0) AS INTEGER)
             END AS delay_minutes
      FROM din""",
    "clamped_delay": f"""WITH {DELAY_IN}
      SELECT l_orderkey, l_linenumber, {_clamp('ct', 'pt')} AS delay_minutes
      FROM din""",
    "xml_roundtrip": f"""WITH {PLAN_RAW}
      SELECT station_name, stop_id, train_category, train_number,
        {_parse("strftime(planned_arrival, '%y%m%d%H%M')")}
          AS planned_arrival,
        platform_arrival,
        {_parse("strftime(planned_departure, '%y%m%d%H%M')")}
          AS planned_departure,
        platform_departure FROM plan_raw""",
    "normalise_names": f"""WITH spelt AS (
        SELECT p_partkey, CASE p_size % 5
          WHEN 0 THEN 'Berlin-' || p_name WHEN 1 THEN p_name || ' (S)'
          WHEN 2 THEN p_name || '(U)' WHEN 3 THEN p_name || ' (S+U) '
          ELSE ' ' || p_name END AS name FROM part
        UNION ALL
        SELECT p_partkey, [{PATH_NAMES}][1 + CAST(p_partkey % 18 AS INTEGER)]
        FROM part)
      SELECT p_partkey, name, {norm_station('name')} AS normalized
      FROM spelt""",
    "unique_stations": f"""WITH {PATHS},
      s AS (SELECT trim(unnest(list_filter(string_split(planned_path, '|'),
                                 lambda x: trim(x) <> ''))) AS x FROM paths)
      SELECT DISTINCT {norm_station('x')} AS station FROM s""",
    "static_graph": f"WITH {GRAPH} SELECT src, dst FROM edges",
    "graph_nodes": f"WITH {GRAPH} SELECT station FROM nodes",
    "q21_lookup_single": f"""WITH {SUPPLIER_DIM},
      hits AS (SELECT * FROM sdim
               WHERE contains(lower(station_name), 'plier#0')),
      best AS (SELECT min((station_name, eva)) AS b FROM hits)
      SELECT h.station_name, h.lat, h.lon, h.eva AS identifier
      FROM hits h JOIN best ON (h.station_name, h.eva) = b""",
    "connections_star": f"""{STAR}, {SUPPLIER_DIM},
      keys AS (
        SELECT snapshot_time_key AS k FROM ev_rows UNION
        SELECT planned_time_key FROM ev_rows UNION
        SELECT changed_time_key FROM ev_rows),
      tdim AS (SELECT k AS time_key,
                 strptime(CAST(k AS VARCHAR), '%Y%m%d%H%M') AS ts
               FROM keys WHERE k IS NOT NULL),
      tev AS (
        SELECT f.train, {norm_station('s.station_name')} AS station,
          f.event_type, t.ts, f.stop_id, CAST(t.ts AS DATE) AS date
        FROM fact f JOIN sdim s ON f.station_key = s.station_key
        JOIN tdim t ON f.planned_time_key = t.time_key
        WHERE f.event_type IN ('A', 'D') AND NOT f.is_cancelled),
      nx AS (
        SELECT *, lead(event_type) OVER w AS n_et,
          lead(station) OVER w AS n_st, lead(ts) OVER w AS n_ts
        FROM tev WINDOW w AS (PARTITION BY train, date
                              ORDER BY ts, event_type, station, stop_id))
      SELECT station AS from_station, n_st AS to_station,
        ts AS departure_time, n_ts AS arrival_time, date
      FROM nx WHERE event_type = 'D' AND n_et = 'A'""",
    "resolve_fuzzy": f"""WITH {GRAPH},
      req AS (SELECT p_partkey AS request_id,
        {norm_station('''CASE p_size % 4
          WHEN 0 THEN 'Stop ' || CAST(p_size AS VARCHAR)
          WHEN 1 THEN 'stop ' || CAST(p_size AS VARCHAR)
          WHEN 2 THEN 'HUB ' || CAST(p_size % 9 AS VARCHAR)
          ELSE 'p ' || CAST(p_size AS VARCHAR) END''')} AS q FROM part),
      c AS (
        SELECT r.request_id, n.station,
          CASE WHEN n.station = r.q THEN 0
               WHEN ends_with(lower(n.station), lower(r.q)) THEN 1
               ELSE 2 END AS score
        FROM req r JOIN nodes n
          ON n.station = r.q OR contains(lower(n.station), lower(r.q)))
      SELECT request_id, arg_min(station, (score, station)) AS station
      FROM c GROUP BY request_id""",
    "shortest_hops": f"""WITH RECURSIVE {GRAPH},
      bfs(node, depth) AS (
        SELECT station, 0 FROM nodes WHERE station = '{HOP_SOURCE}'
        UNION
        SELECT e.dst, b.depth + 1 FROM bfs b JOIN edges e ON e.src = b.node
        WHERE b.depth < (SELECT count(*) FROM nodes))
      SELECT node AS target_station, CAST(min(depth) AS INTEGER) AS hops
      FROM bfs GROUP BY node""",
    "hop_routes": f"""WITH {hop_levels(9)},
      answers AS (
        SELECT r.*, s.node AS source_station, t.node AS target_station
        FROM hop_req r LEFT JOIN part_nodes s ON s.node = r.source
        LEFT JOIN part_nodes t ON t.node = r.target)
      SELECT a.request_id, a.source_station, a.target_station,
        CASE WHEN a.source_station IS NULL THEN 'source not found'
          WHEN a.target_station IS NULL THEN 'target not found'
          WHEN l.path IS NULL THEN 'no path' ELSE 'found' END AS status,
        CAST(len(l.path) - 1 AS INTEGER) AS hops,
        array_to_string(l.path, ' → ') AS path_text
      FROM answers a LEFT JOIN reached l
        ON l.src = a.source_station AND l.node = a.target_station""",
    "earliest_routes": f"""WITH RECURSIVE {PART_STOPS},
      calls AS (
        SELECT l_orderkey, station, line, kind, TIMESTAMP '2025-09-01'
          + to_minutes(CAST(l_orderkey * 37 % 720 + line * 15
            + CASE kind WHEN 'D' THEN 5 ELSE 0 END AS BIGINT)) AS ts
        FROM stops, (VALUES ('A'), ('D')) k(kind)),
      legs AS (
        SELECT station AS frm, kind, ts AS dep, lead(station) OVER w AS dst,
          lead(kind) OVER w AS next_kind, lead(ts) OVER w AS arr
        FROM calls WINDOW w AS (PARTITION BY l_orderkey
          ORDER BY ts, kind, station, CAST(line AS VARCHAR))),
      conn AS (SELECT frm, dst, dep, arr FROM legs
               WHERE kind = 'D' AND next_kind = 'A'),
      st AS (SELECT frm AS node FROM conn UNION SELECT dst FROM conn),
      req AS (
        SELECT c_custkey AS request_id,
          CASE WHEN c_custkey % 97 = 0 THEN 'Nowhere' ELSE
            printf('Part %07d', c_custkey * 7 % 60 + 1) END AS source,
          printf('Part %07d', c_custkey * 131 % 2500 + 1) AS target,
          TIMESTAMP '2025-09-01' + to_hours(CAST(c_custkey % 4 * 3
            AS BIGINT)) AS departure
        FROM customer),
      known AS (
        SELECT r.*, s.node AS source_station, t.node AS target_station
        FROM req r LEFT JOIN st s ON s.node = r.source
        LEFT JOIN st t ON t.node = r.target),
      reach(src, dep0, node, arr) USING KEY (src, dep0, node) AS (
        SELECT DISTINCT source_station, departure, source_station, departure
        FROM known WHERE source_station IS NOT NULL
          AND target_station IS NOT NULL
        UNION
        SELECT n.src, n.dep0, n.dst, n.arr FROM (
          SELECT r.src, r.dep0, c.dst, min(c.arr) AS arr
          FROM reach r JOIN conn c ON c.frm = r.node AND c.dep >= r.arr
          GROUP BY ALL) n
        LEFT JOIN recurring.reach o ON o.src = n.src AND o.dep0 = n.dep0
          AND o.node = n.dst
        WHERE o.arr IS NULL OR n.arr < o.arr)
      SELECT k.request_id, k.source_station, k.target_station, k.departure,
        CASE WHEN k.source_station IS NULL THEN 'source not found'
          WHEN k.target_station IS NULL THEN 'target not found'
          WHEN r.arr IS NULL THEN 'no path' ELSE 'found' END AS status,
        r.arr AS arrival
      FROM known k LEFT JOIN reach r ON r.src = k.source_station
        AND r.dep0 = k.departure AND r.node = k.target_station""",
    "connections": f"WITH {EVENT_CONN} SELECT * FROM conn",
    "earliest_arrival": f"""WITH RECURSIVE {EVENT_CONN},
      st AS (SELECT from_station AS s FROM conn UNION
             SELECT to_station FROM conn),
      reach(station, arr) AS (
        SELECT s, TIMESTAMP '{DEPARTURE}' FROM st WHERE s = 'S0'
        UNION
        SELECT c.to_station, c.arrival_time FROM reach r JOIN conn c
          ON c.from_station = r.station AND c.departure_time >= r.arr)
      SELECT station AS target_station, min(arr) AS arrival
      FROM reach GROUP BY station""",
    "itinerary": f"""WITH RECURSIVE {EVENT_CONN},
      st AS (SELECT from_station AS s FROM conn UNION
             SELECT to_station FROM conn),
      reach(station, arr) AS (
        SELECT s, TIMESTAMP '{DEPARTURE}' FROM st WHERE s = 'S0'
        UNION
        SELECT c.to_station, c.arrival_time FROM reach r JOIN conn c
          ON c.from_station = r.station AND c.departure_time >= r.arr),
      arrv AS (SELECT station, min(arr) AS arr FROM reach GROUP BY station),
      par AS (
        SELECT c.to_station AS station,
          arg_min({{'frm': c.from_station, 'dep': c.departure_time}},
                  (c.departure_time, c.from_station, c.train_id)) AS p
        FROM conn c
        JOIN arrv a ON a.station = c.from_station
                   AND c.departure_time >= a.arr
        JOIN arrv b ON b.station = c.to_station
                   AND c.arrival_time = b.arr
        WHERE c.to_station <> 'S0'
        GROUP BY c.to_station),
      legs(target, step, to_st, frm, dep, arr) AS (
        SELECT a.station, 0, a.station, p.p.frm, p.p.dep, a.arr
        FROM arrv a JOIN par p ON p.station = a.station
        UNION ALL
        SELECT l.target, l.step + 1, l.frm, p.p.frm, p.p.dep, a.arr
        FROM legs l JOIN par p ON p.station = l.frm
        JOIN arrv a ON a.station = l.frm),
      summ AS (
        SELECT target, count(*) AS segments,
          count(DISTINCT to_st) AS stations,
          string_agg(frm || ' (' || strftime(dep, '%H:%M') || ') → '
                     || to_st || ' (' || strftime(arr, '%H:%M') || ')',
                     '; ' ORDER BY step DESC) AS itinerary
        FROM legs GROUP BY target)
      SELECT a.station AS target_station, a.arr AS arrival,
        date_diff('second', TIMESTAMP '{DEPARTURE}', a.arr) / 60.0
          AS duration_minutes,
        CAST(coalesce(s.segments, 0) AS INTEGER) AS segments,
        CAST(coalesce(s.stations, 0) AS INTEGER) AS stations,
        coalesce(s.itinerary, '') AS itinerary
      FROM arrv a LEFT JOIN summ s ON s.target = a.station""",
    "q21_wildcards": f"""WITH {PART_DIM},
      req AS (
        SELECT c_custkey AS request_id, CASE c_custkey % 8
          WHEN 0 THEN '%' || c_custkey
          WHEN 1 THEN substr(CAST(c_custkey AS VARCHAR), 1, 1) || '_'
               || substr(CAST(c_custkey AS VARCHAR), 2, 2)
          WHEN 2 THEN repeat('_', CAST(c_custkey % 40 AS INTEGER))
          WHEN 3 THEN 'R%' || c_custkey WHEN 4 THEN ''
          WHEN 5 THEN ' ' || c_custkey WHEN 6 THEN substr(c_name, 1, 4)
          ELSE '\\_' || c_custkey END AS text FROM customer)
      SELECT request_id, min(station_name) AS station_name,
        arg_min(lat, (station_name, eva)) AS lat,
        arg_min(lon, (station_name, eva)) AS lon,
        arg_min(eva, (station_name, eva)) AS identifier
      FROM req JOIN pdim
        ON station_name ILIKE '%' || text || '%' ESCAPE '\\'
      GROUP BY request_id""",
    "q22_uneven": f"""WITH {PART_DIM},
      town AS (
        SELECT station_name, lat / 10000 + 52.5 AS lat,
          lon / 100000 + 13.4 AS lon FROM pdim
        UNION ALL SELECT 'null island', 0.0, 0.0),
      pts AS (
        SELECT c_custkey AS request_id,
          CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal / 1000000 + 52.5
               ELSE c_acctbal / 120 END AS lat,
          CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey / 1000 + 13.4
               ELSE c_nationkey * 7 - 80.0 END AS lon
        FROM customer)
      SELECT p.request_id, arg_min(t.station_name, ((t.lat - p.lat) ^ 2
        + (t.lon - p.lon) ^ 2, t.station_name)) AS station_name
      FROM pts p, town t GROUP BY p.request_id""",
    "q23_one_snapshot": f"""{XML_STAR}
      SELECT snapshot_time_key, count(DISTINCT (station_key, stop_id))
        AS cancelled_trains
      FROM folded WHERE is_cancelled AND snapshot_time_key = 202509010815
      GROUP BY 1""",
    "q32_absent_station": f"""{LAKE},
      per_day AS (SELECT date, avg(arrival_delay_minutes) AS a FROM movements
                  WHERE NOT is_cancelled AND station_name = 'S3'
                  GROUP BY date)
      SELECT 'S3' AS station_name, round(avg(a), 6) AS final_avg,
        count(*) AS days FROM per_day HAVING count(*) > 0""",
    "q33_top": f"""{LAKE},
      per_day AS (SELECT station_name, date, count(*) AS n FROM movements
                  WHERE planned_departure IS NOT NULL
                    AND hour IN (7, 8, 17, 18)
                  GROUP BY station_name, date),
      per_station AS (
        SELECT station_name, {round2('CAST(sum(n) AS BIGINT)', 'count(*)')}
          AS avg_peak_departures, count(*) AS days_observed
        FROM per_day GROUP BY station_name)
      SELECT * FROM per_station
      ORDER BY avg_peak_departures DESC, station_name LIMIT 7""",
    "check_fk_missing": """
      SELECT l_orderkey, l_linenumber, l_partkey * 2 AS part,
        'fk part' AS rule
      FROM lineitem WHERE l_partkey * 2 NOT IN (SELECT p_partkey FROM part)
      """,
    "change_roundtrip": f"""WITH {CHANGE_RAW}
      SELECT * EXCLUDE (source_file, update_timestamp),
        '2509010800' AS update_timestamp FROM change_raw""",
    "raw_tables": f"WITH {PLAN_RAW} SELECT * FROM plan_raw",
    "lake_counts": """
      SELECT (SELECT count(*) FROM orders) AS plan_rows,
        (SELECT count(*) FROM lineitem JOIN orders
         ON l_orderkey = o_orderkey) AS change_rows""",
    "lake_from_xml": f"""WITH {PLAN_RAW},
      called AS (
        SELECT CAST(l_orderkey AS VARCHAR) AS stop_id,
          max((strptime('20' || strftime(l_shipdate + to_minutes(
            CAST(l_linenumber * 7 AS BIGINT)), '%y%m%d%H%M'),
            '%Y%m%d%H%M'), l_returnflag = 'R')) AS m
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
      latest AS (SELECT stop_id, m[1] AS t, m[2] AS c FROM called)
      SELECT p.stop_id, 'Stop ' || substr(station_name, 2) AS station_name,
        train_category, train_number, planned_arrival,
        u.t AS actual_arrival,
        {_clamp('u.t', 'planned_arrival')} AS arrival_delay_minutes,
        planned_departure, u.t AS actual_departure,
        {_clamp('u.t', 'planned_departure')} AS departure_delay_minutes,
        coalesce(u.c, false) AS is_cancelled,
        CAST(coalesce(planned_departure, planned_arrival) AS DATE) AS date,
        CAST(hour(coalesce(planned_departure, planned_arrival)) AS INTEGER)
          AS hour
      FROM plan_raw p LEFT JOIN latest u USING (stop_id)""",
    "star_written": f"""{XML_STAR},
      minutes AS (
        SELECT DISTINCT {SNAP.format('o_orderkey')} AS k FROM orders UNION
        SELECT planned_time_key FROM prow UNION SELECT ck FROM crow)
      SELECT 'dim_station' AS name, count(DISTINCT o_custkey % 40) AS n
      FROM orders WHERE o_custkey % 40 % 13 <> 12
      UNION ALL SELECT 'dim_train', 1 + count(*) FROM (
        SELECT DISTINCT train_category, train_number FROM pk WHERE known)
      UNION ALL SELECT 'dim_time', count(k) FROM minutes
      UNION ALL SELECT 'fact_train_movement', count(*) FROM folded
      UNION ALL SELECT 'violations', CAST(0 AS BIGINT)""",
    "star_from_xml": f"""{XML_STAR}
      SELECT snapshot_time_key, station_key, stop_id, event_type,
        planned_time_key, changed_time_key, event_status, planned_platform,
        CAST(NULL AS VARCHAR) AS changed_platform, line, planned_path,
        delay_minutes, is_cancelled, category, train_number, '' AS owner,
        '' AS trip_type, '' AS filter_flags
      FROM folded""",
    "star_dim_train": f"""{XML_STAR}
      SELECT DISTINCT train_category AS category, train_number, '' AS owner,
        '' AS trip_type, '' AS filter_flags FROM pk WHERE known
      UNION SELECT 'UNK', 'UNK', '', '', ''""",
    "star_dim_time": f"""{XML_STAR},
      minutes AS (
        SELECT DISTINCT {SNAP.format('o_orderkey')} AS k FROM orders UNION
        SELECT planned_time_key FROM prow UNION
        SELECT ck FROM crow),
      t AS (SELECT k AS time_key, strptime(CAST(k AS VARCHAR),
              '%Y%m%d%H%M') AS ts FROM minutes WHERE k IS NOT NULL)
      SELECT time_key, ts, CAST(ts AS DATE) AS date,
        CAST(hour(ts) AS SMALLINT) AS hour,
        CAST(minute(ts) AS SMALLINT) AS minute,
        CAST(isodow(ts) AS SMALLINT) AS dow, isodow(ts) >= 6 AS is_weekend
      FROM t""",
    "star_load_stats": f"""{XML_STAR}
      SELECT (SELECT count(DISTINCT o_orderkey % 4) FROM orders) AS snapshots,
        (SELECT count(*) FROM prow) + (SELECT count(*) FROM crow)
          AS event_rows,
        (SELECT count(*) FROM pk WHERE NOT known) + (
          SELECT count(DISTINCT o_orderkey) FROM orders
          JOIN lineitem ON l_orderkey = o_orderkey
          WHERE o_custkey % 40 % 13 = 12) AS skipped_station,
        (SELECT count(*) FROM nation WHERE n_nationkey % 3 = 0) AS bad_xml,
        (SELECT count(*) FROM nation WHERE n_nationkey % 3 <> 0)
          AS no_document,
        CAST(0 AS BIGINT) AS unaccounted""",
    "load_constraints": f"""WITH {LI_KEYS}, {PLAN_ROWS}, {CHANGE_ROWS},
      staged AS (
        SELECT snapshot_time_key, station_key, stop_id, event_type,
          event_status, {TRAIN} AS train FROM plan_rows
        UNION ALL
        SELECT snapshot_time_key, station_key,
          CASE WHEN l_linenumber <> 6 THEN stop_id END, event_type,
          CASE WHEN l_linenumber = 5 AND event_status = 'a' THEN 'x'
               ELSE event_status END, {TRAIN} FROM change_rows),
      trains AS (
        SELECT DISTINCT train,
          coalesce(TRY_CAST(train.train_number AS BIGINT), -1) AS key
        FROM (SELECT train FROM staged UNION ALL SELECT {UNK})),
      owner AS (
        SELECT key, arg_min(train, (train <> {UNK}, train.category,
          train.train_number, train.owner, train.trip_type,
          train.filter_flags)) AS train FROM trains GROUP BY key),
      checked AS (
        SELECT *, CASE WHEN stop_id IS NULL THEN 'stop_id not null'
          WHEN event_status NOT IN ('p', 'a', 'c') THEN 'event_status'
          WHEN train NOT IN (SELECT train FROM owner)
          THEN 'train key taken' END AS rule FROM staged)
      SELECT coalesce(rule, 'loaded') AS rule, count(*) AS n FROM checked
      GROUP BY 1
      UNION ALL
      SELECT 'facts', count(DISTINCT (snapshot_time_key, station_key,
        stop_id, event_type)) FROM checked WHERE rule IS NULL
      UNION ALL SELECT 'trains', count(*) FROM owner
      UNION ALL SELECT 'facts without train', CAST(0 AS BIGINT)""",
}

# the connections of one day: no train runs over midnight
ORACLE["connections_day"] = ORACLE["connections_star"] + \
    " AND date = DATE '1995-03-10'"
