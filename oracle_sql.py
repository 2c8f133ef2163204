"""DuckDB SQL that independently computes every registered query.

Written against the driver's pre-registered views (lineitem, orders, ...).
The racing raw tables are rebuilt here in SQL with the same mapping as
``gridlake.plans.racing.from_tpch``; the report statements then follow the
reference's view definitions. Output column names match the Spark side.
"""

from __future__ import annotations

# The racing raw tables, derived from the TPC-H-style tables.
RAW_CTES = r"""
entries AS (
    SELECT l.*, o.o_custkey
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
results AS (
    SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS resultId,
           l_orderkey AS raceId, o_custkey AS driverId,
           l_suppkey AS constructorId, l_partkey AS statusId,
           CAST(l_quantity AS BIGINT) % 20 + 1 AS grid,
           CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS VARCHAR) ELSE '\N' END AS position,
           l_linestatus AS positionText,
           CAST(l_linenumber AS BIGINT) AS positionOrder,
           l_quantity / 2 AS points,
           l_partkey AS laps,
           CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) AS time,
           CASE WHEN l_linestatus = 'F'
                THEN CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END AS milliseconds,
           CAST(l_suppkey AS VARCHAR) AS fastestLap,
           CASE WHEN l_linenumber <> 7 THEN CAST(l_partkey % 20 + 1 AS VARCHAR) ELSE '\N' END AS rank,
           CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) AS fastestLapTime,
           CAST(l_partkey AS VARCHAR) AS fastestLapSpeed,
           l_returnflag
    FROM entries
    WHERE l_returnflag IN ('N', 'R')
),
qualifying AS (
    SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS qualifyId,
           l_orderkey AS raceId, o_custkey AS driverId, l_suppkey AS constructorId,
           CAST(l_linenumber AS BIGINT) AS position,
           CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) AS q1,
           CASE WHEN l_linenumber <= 5 THEN CAST(l_partkey AS VARCHAR) ELSE '\N' END AS q2,
           CASE WHEN l_linenumber <= 3 THEN CAST(l_suppkey AS VARCHAR) ELSE '\N' END AS q3
    FROM entries
    WHERE l_returnflag = 'A'
),
races AS (
    SELECT o_orderkey AS raceId, CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS name
    FROM orders
),
drivers AS (SELECT c_custkey AS driverId, c_mktsegment AS forename, c_name AS surname FROM customer),
constructors AS (SELECT s_suppkey AS constructorId, s_name AS name FROM supplier),
status_list AS (SELECT p_partkey AS statusId, p_type AS status FROM part)
"""

FACT_CTES = r"""
resultFacts AS (
    SELECT r.resultId, r.raceId, 'Normal race' AS race_type,
           ra.name || ' ' || ra.year AS race_name,
           d.forename || ' ' || d.surname AS driver_name,
           c.name AS constructor_name, r.grid AS starting_grid, r.position,
           r.positionText AS finishPosition, r.positionOrder AS finishOrder,
           r.points, r.laps, r.time || '.' || r.milliseconds AS raced_time,
           r.fastestLap, r.rank, r.fastestLapTime,
           r.fastestLapSpeed AS fastestLapSpeed_kmph, s.status
    FROM results r
    JOIN status_list s ON r.statusId = s.statusId
    JOIN races ra ON r.raceId = ra.raceId
    JOIN drivers d ON r.driverId = d.driverId
    JOIN constructors c ON r.constructorId = c.constructorId
    WHERE r.l_returnflag = 'N'
    UNION
    SELECT r.resultId, r.raceId, 'Sprint race' AS race_type,
           ra.name || ' ' || ra.year AS race_name,
           d.forename || ' ' || d.surname AS driver_name,
           c.name AS constructor_name, r.grid AS starting_grid, r.position,
           r.positionText AS finishPosition, r.positionOrder AS finishOrder,
           r.points, r.laps, r.time || '.' || r.milliseconds AS raced_time,
           r.fastestLap, NULL AS rank, r.fastestLapTime,
           NULL AS fastestLapSpeed_kmph, s.status
    FROM results r
    JOIN status_list s ON r.statusId = s.statusId
    JOIN races ra ON r.raceId = ra.raceId
    JOIN drivers d ON r.driverId = d.driverId
    JOIN constructors c ON r.constructorId = c.constructorId
    WHERE r.l_returnflag = 'R'
),
qualiFacts AS (
    SELECT q.qualifyId, q.raceId, ra.name || ' ' || ra.year AS race_name,
           d.forename || ' ' || d.surname AS driver_name, c.name AS constructor_name,
           q.position AS finalQualiPosition, q.q1 AS q1Time, q.q2 AS q2Time, q.q3 AS q3Time
    FROM qualifying q
    JOIN races ra ON q.raceId = ra.raceId
    JOIN drivers d ON q.driverId = d.driverId
    JOIN constructors c ON q.constructorId = c.constructorId
)
"""

FASTEST = r"(CASE WHEN rank = '\N' THEN '20' ELSE rank END) = '1' AND race_type = 'Normal race'"
POINTS = "CAST(SUM(CAST(points AS DECIMAL(30, 8))) AS DOUBLE)"


def _racing(body: str) -> str:
    return "WITH " + RAW_CTES.strip() + ",\n" + FACT_CTES.strip() + "\n" + body


def _ranked(source: str, key: str, measure: str, alias: str, where: str = "") -> str:
    cond = f"WHERE {where}" if where else ""
    return _racing(
        f"SELECT {key}, {measure} AS {alias} FROM {source} {cond} "
        f"GROUP BY {key} ORDER BY {alias} DESC NULLS LAST, {key} ASC NULLS LAST"
    )


def _year(y: int) -> str:
    return f"right(race_name, 4) = '{y}'"


RACING = {
    "resultFacts": _racing("SELECT * FROM resultFacts"),
    "qualiFacts": _racing("SELECT * FROM qualiFacts"),
    "constructorPoints": _ranked("resultFacts", "constructor_name", POINTS, "constructor_points"),
    "driverPoints": _ranked("resultFacts", "driver_name", POINTS, "driver_points"),
    "driverPointsIn1997": _ranked("resultFacts", "driver_name", POINTS, "driver_points", _year(1997)),
    "fastestLapsPerRace": _racing(
        f"SELECT race_name, driver_name, fastestLapTime FROM resultFacts WHERE {FASTEST} "
        "ORDER BY raceId ASC NULLS LAST, driver_name ASC NULLS LAST, fastestLapTime ASC NULLS LAST"
    ),
    "fastestLapsPerRaceIn2000": _racing(
        f"SELECT race_name, driver_name, fastestLapTime FROM resultFacts WHERE {_year(2000)} AND {FASTEST} "
        "ORDER BY raceId ASC NULLS LAST, driver_name ASC NULLS LAST, fastestLapTime ASC NULLS LAST"
    ),
    "fastestLapsPerDriver": _ranked("resultFacts", "driver_name", "COUNT(*)", "num_fastest_laps", FASTEST),
    "fastestLapsPerConst": _ranked("resultFacts", "constructor_name", "COUNT(*)", "num_fastest_laps", FASTEST),
    "mostWinsFromPole": _ranked(
        "resultFacts", "driver_name", "COUNT(*)", "TimesWonFromPole", "starting_grid = 1 AND finishOrder = 1"
    ),
    "driversWinFromFarBack": _racing(
        "SELECT driver_name, race_name AS raceName, starting_grid AS startedFrom, "
        "starting_grid - finishOrder AS positionsGained FROM resultFacts WHERE finishOrder = 1 "
        "ORDER BY positionsGained DESC NULLS LAST, driver_name ASC NULLS LAST, raceName ASC NULLS LAST, "
        "startedFrom ASC NULLS LAST"
    ),
    "mostWinsFromFarBack": _ranked(
        "resultFacts", "driver_name", "COUNT(*)", "winAttempts", "finishOrder = 1 AND starting_grid - finishOrder >= 5"
    ),
    "mostPositionsGainedByDriver": _ranked(
        "resultFacts", "driver_name", "COUNT(*)", "positionsGained", "points >= 1 AND starting_grid - finishOrder >= 5"
    ),
    "mostWinsFromDifferentPositions": _ranked(
        "resultFacts", "driver_name", "COUNT(DISTINCT starting_grid)", "gridPositions", "finishOrder = 1"
    ),
    "mostWinsPerDriverWithoutSprint": _ranked(
        "resultFacts", "driver_name", "COUNT(*)", "winsPerDriver", "finishOrder = 1 AND race_type = 'Normal race'"
    ),
    "mostWinsPerConstWithoutSprint": _ranked(
        "resultFacts", "constructor_name", "COUNT(*)", "winsPerDriver", "finishOrder = 1 AND race_type = 'Normal race'"
    ),
    "mostPolesPerDriver": _ranked("qualiFacts", "driver_name", "COUNT(*)", "polesPerDriver", "finalQualiPosition = 1"),
    "mostPolesPerConst": _ranked(
        "qualiFacts", "constructor_name", "COUNT(*)", "polesPerDriver", "finalQualiPosition = 1"
    ),
    "raceDriverSample": _racing(
        "SELECT ra.name || ' ' || ra.year AS race_name, d.forename || ' ' || d.surname AS driver_name "
        "FROM results r JOIN races ra ON r.raceId = ra.raceId JOIN drivers d ON r.driverId = d.driverId "
        "WHERE r.l_returnflag = 'N' "
        "ORDER BY race_name ASC NULLS LAST, driver_name ASC NULLS LAST LIMIT 10"
    ),
}


EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


def _events_log(o: str) -> str:
    """The change log derived from events; ``o`` is the ordering column."""
    best = f"({o} IS NOT NULL) DESC, {o} DESC, event_id DESC"
    return f"""
ev AS (SELECT {EVENT_COLS} FROM events),
o_rows AS (
    SELECT {EVENT_COLS}, 'O' AS _op FROM (
        SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY {best}) AS rn
        FROM ev WHERE day(ts) = 1
    ) WHERE rn = 1
),
other_rows AS (
    SELECT {EVENT_COLS},
           CASE WHEN event_type IN ('signup', 'purchase') THEN 'I'
                WHEN event_type IN ('click', 'view') THEN 'U' ELSE 'D' END AS _op
    FROM ev WHERE day(ts) <> 1
),
lg AS (
    SELECT *, strftime(ts, '%Y%m%d')
              || CASE _op WHEN 'O' THEN '01' WHEN 'I' THEN '02' WHEN 'U' THEN '03' ELSE '04' END
              || '0000000' AS _commit_time,
           CAST(year(ts) AS INTEGER) AS year
    FROM (SELECT * FROM o_rows UNION ALL SELECT * FROM other_rows)
)"""


def keyed_snapshot_sql(o: str = "value", mode: str = "event", as_of: str | None = None,
                       begin: str | None = None) -> str:
    """Row-level window formulation of the snapshot rules (independent of the
    per-(key, commit) summary the Spark side uses)."""
    best = f"({o} IS NOT NULL) DESC, {o} DESC, event_id DESC"
    upto = f"WHERE _commit_time <= '{as_of}'" if as_of else ""
    fire = "" if mode == "commit" else f"AND (p.prev IS NULL OR r.{o} >= p.prev)"
    after = f"WHERE _commit_time > '{begin}'" if begin else ""
    return f"""WITH {_events_log(o).strip()},
lg2 AS (SELECT * FROM lg {upto}),
live AS (
    SELECT * FROM lg2
    WHERE _commit_time >= (SELECT coalesce(max(_commit_time), '') FROM lg2 WHERE _op = 'O')
),
kept AS (
    SELECT * EXCLUDE (cd) FROM (
        SELECT *, max(CASE WHEN _op = 'D' THEN _commit_time END) OVER (PARTITION BY user_id) AS cd FROM live
    ) WHERE _op <> 'D' AND (cd IS NULL OR _commit_time > cd)
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id, _commit_time ORDER BY {best}) AS rn FROM kept
),
cmax AS (SELECT user_id, _commit_time, max({o}) AS mv FROM kept GROUP BY user_id, _commit_time),
prior AS (
    SELECT user_id, _commit_time,
           max(mv) OVER (PARTITION BY user_id ORDER BY _commit_time
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
    FROM cmax
),
fired AS (
    SELECT r.* EXCLUDE (rn) FROM ranked r
    JOIN prior p ON r.user_id = p.user_id AND r._commit_time = p._commit_time
    WHERE r._op = 'U' AND r.rn = 1 {fire}
),
last_u AS (SELECT user_id, max(_commit_time) AS cu FROM fired GROUP BY user_id),
snap AS (
    SELECT f.* FROM fired f JOIN last_u l ON f.user_id = l.user_id AND f._commit_time = l.cu
    UNION ALL
    SELECT k.* FROM kept k LEFT JOIN last_u l ON k.user_id = l.user_id
    WHERE k._op IN ('I', 'O') AND (l.cu IS NULL OR k._commit_time > l.cu)
)
SELECT {EVENT_COLS}, _op, _commit_time, year FROM snap {after}"""


KEYED = {
    "keyedCreateDedupe": f"""SELECT {EVENT_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (ts IS NOT NULL) DESC, ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1""",
    "keyedSnapshotEvent": keyed_snapshot_sql("value", "event"),
    "keyedSnapshotEventByTs": keyed_snapshot_sql("ts", "event"),
    "keyedSnapshotCommit": keyed_snapshot_sql("value", "commit"),
    "keyedAsOf": keyed_snapshot_sql("value", "event", as_of="20240112999999999"),
    "keyedIncremental": keyed_snapshot_sql("value", "event", begin="20240125000000000"),
    "keyedIncrementalBetween": keyed_snapshot_sql("value", "event", as_of="20240117999999999", begin="20240108000000000"),
    # The resolved rows stored and read through an external table: same answers.
    "keyedTableSnapshot": keyed_snapshot_sql("value", "event"),
    "keyedTableCompacted": keyed_snapshot_sql("value", "event"),
    "keyedTableAsOf": keyed_snapshot_sql("value", "event", as_of="20240112999999999"),
    # The log copied by Structured Streaming, then resolved: same answer.
    "keyedReplicaSnapshot": keyed_snapshot_sql("value", "event"),
}


RACING["raceDriverUnion"] = _racing(
    "SELECT ra.name || ' ' || ra.year AS race_name, d.forename || ' ' || d.surname AS driver_name "
    "FROM results r JOIN races ra ON r.raceId = ra.raceId JOIN drivers d ON r.driverId = d.driverId "
    "WHERE r.l_returnflag = 'N' "
    "UNION "
    "SELECT ra.name || ' ' || ra.year AS race_name, d.forename || ' ' || d.surname AS driver_name "
    "FROM results r JOIN races ra ON r.raceId = ra.raceId JOIN drivers d ON r.driverId = d.driverId "
    "WHERE r.l_returnflag = 'R'"
)

EXT_RE = r"^\.*[^.].*(\.[^.]*)$"


def _ext(x: str) -> str:
    return f"regexp_extract(regexp_extract({x}, '([^/]*)$', 1), '{EXT_RE}', 1)"


def _ftype(x: str) -> str:
    return f"regexp_replace({_ext(x)}, '^\\.', '')"


PAGE_URL_PARTS = f"""
WITH k AS (SELECT page_id, regexp_replace(url, '^[a-z]+://[^/]*/?', '') AS key FROM pages),
p AS (
    SELECT page_id, key,
           regexp_extract(key, '([^/]*)$', 1) AS file_name,
           {_ext('key')} AS ext,
           {_ftype('key')} AS file_type,
           left(key, length(key) - length({_ext('key')})) AS stripped
    FROM k
)
SELECT page_id, key, file_name,
       left(file_name, length(file_name) - length(ext)) AS stem,
       ext, file_type,
       CASE WHEN file_type IN ('gz') THEN {_ftype('stripped')} ELSE file_type END AS read_format,
       file_type IN ('csv', 'parquet', 'json', 'txt', 'orc', 'gz', 'avro') AS valid,
       CASE WHEN ext <> '' THEN stripped || '.parquet' END AS target_key,
       CASE WHEN ext <> '' THEN 'inputs/' || left(file_name, length(file_name) - length(ext)) || '.parquet' END
           AS target_in_dir
FROM p
"""

NAME_RULES = r"""
WITH names AS (
    SELECT 'page_host' AS source, page_id AS id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS name FROM pages
    UNION ALL SELECT 'part_name', p_partkey, p_name FROM part
    UNION ALL SELECT 'nation_name', CAST(n_nationkey AS BIGINT), lower(n_name) FROM nation
),
f AS (
    SELECT *, list_filter([
        CASE WHEN length(name) < 3 OR length(name) > 63 THEN 'Bucket name must be between 3 and 63 characters.' END,
        CASE WHEN NOT regexp_matches(name, '^[a-z0-9.-]+$')
             THEN 'Bucket name should contain only lowercase, numbers, periods (.), dashes (-)' END,
        CASE WHEN contains(name, '_') THEN 'Bucket name cannot contain underscore (_)' END,
        CASE WHEN suffix(name, '-') THEN 'Bucket name cannot end with dash (-)' END,
        CASE WHEN contains(name, '..') THEN 'Bucket name cannot contain double periods (..)' END,
        CASE WHEN contains(name, '.-') OR contains(name, '-.')
             THEN 'Bucket name cannot have dashes and periods next to each other' END,
        CASE WHEN regexp_matches(name, '^(\d{1,3}\.){3}\d{1,3}$') THEN 'Bucket name cannot be in IP address format' END
    ], lambda x: x IS NOT NULL) AS fails
    FROM names
)
SELECT source, id, name,
       CASE WHEN name IS NULL THEN NULL
            WHEN len(fails) = 0 THEN 'Success'
            ELSE 'Failed!' || chr(10) || array_to_string(fails, chr(10)) END AS verdict,
       CASE WHEN name IS NOT NULL THEN CAST(len(fails) AS INTEGER) END AS n_failures
FROM f
"""

OBJECTS = {
    "pageUrlParts": PAGE_URL_PARTS,
    "bucketNameRules": NAME_RULES,
    "scanByExtension": "SELECT * FROM customer",
    "directFileQuery": "SELECT * FROM orders",
}


_FORMATS = ("csv", "csv_gz", "json", "json_gz", "orc", "parquet")
_CODED = "SELECT *, CASE s_suppkey % 4 WHEN 0 THEN '007' WHEN 1 THEN '1.50' WHEN 2 THEN '' END AS code FROM supplier"

ROUND_TRIPS = {
    "bulkConvertRoundTrip": "SELECT * FROM customer",
    "bucketToTables": "SELECT * FROM customer",
    "convertThenLoad": RACING["raceDriverSample"],
    "scanFormats": " UNION ALL ".join(f"SELECT *, '{f}' AS read_from FROM supplier" for f in _FORMATS),
    "fileToTableAndBack": "SELECT * FROM part",
    **{f"exportImport{f}": _CODED for f in ("Parquet", "Csv", "Json", "Orc", "Arrow")},
    "partitionedEvents": "SELECT *, year(ts) AS year, month(ts) AS month, day(ts) AS day FROM events",
    "listedObjects": """
WITH parts AS (
    SELECT 'status=' || o_orderstatus || '/digit=' || o_orderkey % 10 || '/' AS folder, o_orderstatus AS status, o_orderkey % 10 AS digit,
           CAST(ceil(count(*) / 50.0) AS BIGINT) AS n
    FROM orders GROUP BY ALL
)
SELECT folder, n AS n_objects, n AS n_keys, true AS all_filled, 0 AS dirs, 'all' AS how FROM parts
UNION ALL SELECT '', 1, 1, true, 0, 'hidden'
UNION ALL SELECT folder, n, n, true, 0, 'prefix' FROM parts WHERE status = 'F'
UNION ALL SELECT folder, n, n, true, 0, 'start_after' FROM parts WHERE status = 'O' AND digit >= 5
UNION ALL SELECT DISTINCT 'status=' || status || '/', 1, 1, true, 1, 'folders' FROM parts""",
    "prefixesWithObjects": """
SELECT 'status=' || s || '/digit=' || d || '/' AS prefix, EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = s AND o_orderkey % 10 = d) AS has_objects
FROM (VALUES ('F'), ('O'), ('P'), ('X')) a(s), (VALUES (0), (7)) b(d)
UNION ALL SELECT * FROM (VALUES ('status=', true), ('status=F', EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F')), ('digit=', false), ('_SUCCESS', true), ('_SUCCESS/', false)) v""",
    "mixedHeaders": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderstatus END AS o_orderstatus FROM orders",
    "pointLookup": "SELECT * FROM orders WHERE o_orderkey = 7",
    # One pass per operation: what each leaves of the rows before it.
    "keyedOperations": """
WITH ev AS (SELECT *, day(ts) AS day FROM events),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id, day <= 10 ORDER BY value DESC NULLS LAST, event_id DESC) AS rn
    FROM ev WHERE day <= 10 OR day > 20
),
stored AS (
    SELECT * EXCLUDE (rn) FROM ranked WHERE day <= 10 AND rn = 1
    UNION ALL SELECT * FROM ev WHERE day > 10 AND day <= 20 AND event_type = 'purchase'
),
firing AS (
    SELECT r.* EXCLUDE (rn) FROM ranked r
    WHERE r.day > 20 AND r.rn = 1 AND NOT EXISTS (
        SELECT 1 FROM stored s WHERE s.user_id = r.user_id AND s.value IS NOT NULL AND (r.value IS NULL OR s.value > r.value))
)
SELECT * FROM (
    SELECT * FROM firing UNION ALL SELECT * FROM stored WHERE user_id NOT IN (SELECT user_id FROM firing)
) WHERE user_id NOT IN (SELECT user_id FROM ev WHERE day = 30 AND event_type = 'error')""",
    "pointLookupBloom": "SELECT * FROM orders WHERE o_orderkey IN (11, -5)",
    "keyedStoredUpsert": """
WITH ev AS (SELECT *, CAST(day(ts) AS INTEGER) AS day FROM events),
old AS (SELECT * FROM ev WHERE day <= 20 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1),
new AS (
    SELECT * FROM ev WHERE day > 20 AND event_type = 'purchase'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
)
SELECT * FROM (SELECT * FROM new UNION ALL SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM new))
WHERE user_id NOT IN (SELECT user_id FROM ev WHERE day = 30 AND event_type = 'error')""",
    # The order that a report's ORDER BY gives, as a column.
    "ranked_driverPoints": "SELECT *, row_number() OVER (ORDER BY driver_points DESC NULLS LAST, driver_name ASC NULLS LAST) AS rank FROM (" + RACING["driverPoints"] + ")",
    "ranked_mostPolesPerDriver": "SELECT *, row_number() OVER (ORDER BY polesPerDriver DESC NULLS LAST, driver_name ASC NULLS LAST) AS rank FROM (" + RACING["mostPolesPerDriver"] + ")",
    "ranked_driversWinFromFarBack": "SELECT *, row_number() OVER (ORDER BY positionsGained DESC NULLS LAST, driver_name, raceName, startedFrom) AS rank FROM (" + RACING["driversWinFromFarBack"] + ")",
    "ranked_fastestLapsPerRace": RACING["fastestLapsPerRace"].replace(
        "race_name, driver_name, fastestLapTime FROM",
        "race_name, driver_name, fastestLapTime, row_number() OVER (ORDER BY raceId NULLS LAST, driver_name NULLS LAST, fastestLapTime NULLS LAST) AS rank FROM"
    ),
    "allLeaderboards": " UNION ALL ".join(
        f"SELECT '{name}' AS report, {key} AS name, CAST({value} AS DOUBLE) AS value FROM (" + RACING[name] + ")"
        for name, key, value in (
            ("constructorPoints", "constructor_name", "constructor_points"), ("driverPoints", "driver_name", "driver_points"),
            ("fastestLapsPerDriver", "driver_name", "num_fastest_laps"), ("fastestLapsPerConst", "constructor_name", "num_fastest_laps"),
            ("mostWinsFromPole", "driver_name", "TimesWonFromPole"), ("mostWinsFromFarBack", "driver_name", "winAttempts"),
            ("mostPositionsGainedByDriver", "driver_name", "positionsGained"), ("mostWinsFromDifferentPositions", "driver_name", "gridPositions"),
            ("mostWinsPerDriverWithoutSprint", "driver_name", "winsPerDriver"), ("mostWinsPerConstWithoutSprint", "constructor_name", "winsPerDriver"),
            ("mostPolesPerDriver", "driver_name", "polesPerDriver"), ("mostPolesPerConst", "constructor_name", "polesPerDriver"),
        )
    ),
    # The stored views answer as the reports do.
    **{f"view_{name}": RACING[name] for name in RACING if name.startswith(("constructor", "driver", "fastest", "most")) and not name.endswith(("1997", "2000"))},
}


def all_sql() -> dict[str, str]:
    out = dict(RACING)
    out.update(KEYED)
    out.update(OBJECTS)
    out.update(ROUND_TRIPS)
    return out
