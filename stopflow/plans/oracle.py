"""Independent SQL (DuckDB dialect) for every registered query.

Only the driver's base tables exist on the DuckDB side, so each statement
inlines the timetable views (``raw_stops``, ``station_meta``,
``train_meta``, ``clean``, ``stops``) as CTEs.  This SQL is the oracle the
Spark operators are checked against; it is not used to compute results.
"""

from __future__ import annotations

RAW_STOPS = """
raw_b AS (
  SELECT l.*, s.s_name,
         (l_orderkey*37 + l_linenumber*53 + l_partkey*11) % 1440 AS am,
         (l_orderkey*37 + l_linenumber*53 + l_partkey*11 + CAST(l_quantity AS INT)) % 1440 AS dm
  FROM lineitem l JOIN supplier s ON l_suppkey = s_suppkey),
raw_t AS (
  SELECT CASE WHEN l_partkey % 103 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS number,
    CASE WHEN l_orderkey % 211 = 0 THEN 'None' ELSE concat(' Service ', CAST(l_orderkey AS STRING)) END AS trainName,
    CASE WHEN l_partkey % 101 = 0 THEN 'none'
         ELSE concat('S', lpad(CAST(l_suppkey AS STRING), 5, '0'), ' ') END AS station,
    s_name AS station_name,
    CASE WHEN l_linenumber = 1 THEN 'None' WHEN l_partkey % 97 = 0 THEN ' NaN ' WHEN l_partkey % 83 = 0 THEN 'bad'
         ELSE concat(lpad(CAST(CAST(floor(am/60) AS INT) AS STRING),2,'0'), ':', lpad(CAST(am % 60 AS STRING),2,'0'), ':00') END AS arrival,
    CASE WHEN l_linenumber = 7 THEN '' WHEN l_partkey % 89 = 0 THEN 'null'
         ELSE concat(' ', lpad(CAST(CAST(floor(dm/60) AS INT) AS STRING),2,'0'), ':', lpad(CAST(dm % 60 AS STRING),2,'0'), ':00') END AS departure,
    CAST(1 + floor((l_linenumber-1)/2) AS INT) AS day,
    CAST(l_linenumber AS BIGINT)*1000000000 + l_partkey*10000 + l_suppkey AS id,
    l_partkey AS pk
  FROM raw_b),
raw_stops AS (
  SELECT number, trainName, station, station_name, arrival, departure, day, id FROM raw_t
  UNION ALL
  SELECT number, trainName, station, station_name, arrival, departure, day, id FROM raw_t WHERE pk % 53 = 0)"""

STATION_META = """
station_meta AS (
  SELECT concat(' S', lpad(CAST(s_suppkey AS STRING),5,'0')) AS code,
         CASE WHEN n_nationkey=9 THEN '' ELSE n_name END AS state,
         CASE WHEN n_nationkey=7 THEN '?' ELSE r_name END AS zone
  FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey
  WHERE s_suppkey % 25 <> 0
  UNION ALL
  SELECT concat('S', lpad(CAST(s_suppkey AS STRING),5,'0')), 'ZZ_DUP', 'ZZ' FROM supplier WHERE s_suppkey % 10 = 3)"""

TRAIN_META = """
train_meta AS (
  SELECT CAST(o_orderkey AS STRING) AS number, o_orderpriority AS type FROM orders WHERE o_orderkey % 50 <> 0)"""

CLEAN = """
clean_m AS (SELECT DISTINCT number AS train_number,
    CASE WHEN lower(trim(trainName)) IN ('','none') THEN NULL ELSE trim(trainName) END AS train_name,
    CASE WHEN lower(trim(station)) IN ('','none') THEN NULL ELSE trim(station) END AS station_code,
    CASE WHEN lower(trim(station_name)) IN ('','none') THEN NULL ELSE trim(station_name) END AS station_name,
    CASE WHEN lower(trim(arrival)) IN ('','none','nan','null') THEN NULL ELSE trim(arrival) END AS arrival,
    CASE WHEN lower(trim(departure)) IN ('','none','nan','null') THEN NULL ELSE trim(departure) END AS departure,
    day, id AS stop_sequence FROM raw_stops),
clean_f AS (SELECT *, TRY_CAST(split_part(arrival,':',1) AS INT)*60 + TRY_CAST(split_part(arrival,':',2) AS INT) AS a,
                TRY_CAST(split_part(departure,':',1) AS INT)*60 + TRY_CAST(split_part(departure,':',2) AS INT) AS d
      FROM clean_m WHERE train_number IS NOT NULL AND station_code IS NOT NULL),
clean AS (
  SELECT train_number, train_name, station_code, station_name,
         substr(arrival,1,5) AS arrival, substr(departure,1,5) AS departure, day, stop_sequence,
         CAST(CASE WHEN d >= a THEN d-a ELSE d+1440-a END AS INT) AS stop_duration_mins FROM clean_f)"""

STOPS = """
stops AS (
  SELECT c.*, sm.state, sm.zone, tm.train_type FROM clean c
  LEFT JOIN (SELECT trim(code) k, min(trim(state)) state, min(trim(zone)) zone
             FROM station_meta WHERE trim(code) <> '' GROUP BY 1) sm ON c.station_code = sm.k
  LEFT JOIN (SELECT trim(number) k, min(trim(type)) train_type
             FROM train_meta WHERE trim(number) <> '' GROUP BY 1) tm ON c.train_number = tm.k)"""

PREAMBLE = "WITH " + ",".join([RAW_STOPS, STATION_META, TRAIN_META, CLEAN, STOPS]) + ",\n"

# A stop's place on its route: nulls first, ties by what is shown of the stop.
_PLACE = ("stop_sequence", "arrival", "departure", "station_code", "station_name", "train_name", "train_type")
FORWARD = ", ".join(f"{c} NULLS FIRST" for c in _PLACE)
BACKWARD = ", ".join(f"{c} DESC NULLS LAST" for c in _PLACE)

# Derived result tables referenced by several oracle statements.
DERIVED = {
    "busiest": "SELECT station_code, station_name, count(*) AS total_stops, count(DISTINCT train_number) AS distinct_trains "
               "FROM stops GROUP BY 1,2 ORDER BY 3 DESC,1,2 LIMIT 20",
    "stoppage": "SELECT station_code, station_name, count(*) AS num_stops, round(avg(stop_duration_mins),1) AS avg_duration_mins, "
                "max(stop_duration_mins) AS max_duration_mins, quantile_disc(stop_duration_mins,0.9) AS p90_duration_mins "
                "FROM stops WHERE stop_duration_mins IS NOT NULL GROUP BY 1,2 HAVING count(*) >= 20",
    "hourly": "SELECT TRY_CAST(split_part(arrival,':',1) AS INT) AS hour, count(*) AS arrivals FROM stops "
              "WHERE arrival IS NOT NULL GROUP BY 1",
    "dense": "SELECT CAST(h.hour AS INT) AS hour, coalesce(t.arrivals,0) AS arrivals FROM range(24) h(hour) "
             "LEFT JOIN (SELECT TRY_CAST(split_part(arrival,':',1) AS INT) AS hour, count(*) AS arrivals FROM stops "
             "WHERE arrival IS NOT NULL GROUP BY 1) t ON h.hour = t.hour",
    "timetable": "SELECT train_number, train_name, train_type, station_code, station_name, arrival, departure, "
                 "stop_duration_mins, day, stop_sequence FROM stops WHERE station_name = 'Supplier#000000003'",
    "catalog": "SELECT train_number, train_name, train_type, train_number||' — '||coalesce(train_name,'None')||' ('||"
               "coalesce(nullif(train_type,''),'Rail')||')' AS label FROM (SELECT *, row_number() OVER "
               f"(PARTITION BY train_number ORDER BY {FORWARD}) AS rn FROM stops) WHERE rn = 1",
    "longest": "SELECT train_number, train_name, count(*) AS num_stops FROM stops GROUP BY 1,2 ORDER BY 3 DESC,1,2 LIMIT 20",
    "bd_zone": "SELECT zone, count(*) AS total_stops, count(DISTINCT train_number) AS distinct_trains FROM stops GROUP BY 1",
    "bd_type": "SELECT train_type, count(*) AS total_stops, count(DISTINCT train_number) AS distinct_trains FROM stops GROUP BY 1",
}


def _with(sql: str, *derived: str) -> str:
    extra = "".join(f"{d} AS ({DERIVED[d]}),\n" for d in derived)
    return PREAMBLE + extra + "_q AS (" + sql + ")\nSELECT * FROM _q"


ORACLE: dict[str, str] = {
    "clean_times": _with("SELECT id, CASE WHEN lower(trim(arrival)) IN ('','none','nan','null') THEN NULL ELSE trim(arrival) END AS arrival, "
                         "CASE WHEN lower(trim(departure)) IN ('','none','nan','null') THEN NULL ELSE trim(departure) END AS departure FROM raw_stops"),
    "clean_names": _with("SELECT id, CASE WHEN lower(trim(trainName)) IN ('','none') THEN NULL ELSE trim(trainName) END AS train_name, "
                             "CASE WHEN lower(trim(station)) IN ('','none') THEN NULL ELSE trim(station) END AS station_code, "
                             "CASE WHEN lower(trim(station_name)) IN ('','none') THEN NULL ELSE trim(station_name) END AS station_name FROM raw_stops"),
    "clean_all_names": _with("SELECT id, CASE WHEN lower(trim(trainName)) IN ('','none') THEN NULL ELSE trim(trainName) END AS train_name, "
                             "CASE WHEN lower(trim(station)) IN ('','none') THEN NULL ELSE trim(station) END AS station_code, "
                             "CASE WHEN lower(trim(station_name)) IN ('','none') THEN NULL ELSE trim(station_name) END AS station_name FROM raw_stops"),
    "times_to_minutes": _with("SELECT id, TRY_CAST(split_part(trim(arrival),':',1) AS INT)*60 + TRY_CAST(split_part(trim(arrival),':',2) AS INT) AS arrival_min, "
                              "TRY_CAST(split_part(trim(departure),':',1) AS INT)*60 + TRY_CAST(split_part(trim(departure),':',2) AS INT) AS departure_min FROM raw_stops"),
    "time_to_minutes": _with("SELECT id, TRY_CAST(split_part(trim(arrival),':',1) AS INT)*60 + TRY_CAST(split_part(trim(arrival),':',2) AS INT) AS arrival_min, "
                              "TRY_CAST(split_part(trim(departure),':',1) AS INT)*60 + TRY_CAST(split_part(trim(departure),':',2) AS INT) AS departure_min FROM raw_stops"),
    "conform_stops": _with("SELECT number AS train_number, trainName AS train_name, station AS station_code, station_name, arrival, departure, day, id AS stop_sequence FROM raw_stops"),
    "drop_missing_keys": _with("SELECT number AS train_number, trim(station) AS station_code, id FROM raw_stops "
                               "WHERE number IS NOT NULL AND lower(trim(station)) NOT IN ('','none')"),
    "dedup_exact": _with("SELECT DISTINCT * FROM raw_stops"),
    "dedup_batches": _with("SELECT DISTINCT * FROM raw_stops"),
    "clean_stops": _with("SELECT * FROM clean"),
    "stop_duration": _with("SELECT train_number, stop_sequence, arrival, departure, stop_duration_mins FROM clean"),
    "midnight_crossings": _with("SELECT train_number, stop_sequence, station_code, stop_duration_mins FROM clean "
                                "WHERE stop_duration_mins IS NOT NULL AND departure < arrival"),
    "clean_stats": _with("SELECT CAST((SELECT count(*) FROM raw_stops) AS BIGINT) AS raw_rows, (SELECT count(*) FROM clean) AS cleaned_rows, "
                         "(SELECT count(*) FROM raw_stops WHERE number IS NULL OR lower(trim(station)) IN ('','none')) AS removed_missing, "
                         "(SELECT count(*) FROM raw_stops WHERE number IS NOT NULL AND lower(trim(station)) NOT IN ('','none')) - "
                         "(SELECT count(*) FROM clean) AS removed_duplicates"),
    "geojson_flatten": _with("SELECT trim(code) AS code, trim(state) AS state, trim(zone) AS zone FROM station_meta WHERE trim(code) <> ''"),
    "geojson_trains": _with("SELECT trim(number) AS number, trim(type) AS type FROM train_meta WHERE trim(number) <> ''"),
    "scan_json_array": _with("SELECT * FROM raw_stops"),
    "dim_dedup": _with("SELECT trim(code) AS code, min(trim(state)) AS state, min(trim(zone)) AS zone FROM station_meta "
                       "WHERE trim(code) <> '' GROUP BY 1"),
    "enrich_station": _with("SELECT train_number, stop_sequence, departure, state, zone FROM stops"),
    "enrich_train": _with("SELECT train_number, stop_sequence, departure, train_type FROM stops"),
    "enriched_stops": _with("SELECT * FROM stops"),
    "enrich_unmatched": _with("SELECT DISTINCT station_code FROM clean WHERE station_code NOT IN (SELECT trim(code) FROM station_meta)"),
    "busiest_stations": _with("SELECT * FROM busiest", "busiest"),
    "busiest_search": _with("SELECT * FROM busiest WHERE regexp_matches(lower(station_name),'00[1-4]') OR "
                            "regexp_matches(lower(station_code),'00[1-4]') ORDER BY total_stops DESC, station_code LIMIT 5", "busiest"),
    "stoppage_stats": _with("SELECT * FROM stoppage", "stoppage"),
    "stoppage_filtered": _with("SELECT * FROM stoppage WHERE num_stops >= 400 AND avg_duration_mins >= 25.0", "stoppage"),
    "stoppage_search": _with("SELECT * FROM stoppage WHERE num_stops >= 50 AND avg_duration_mins >= 10.0 AND "
                             "(regexp_matches(lower(station_name),'0001') OR regexp_matches(lower(station_code),'0001'))", "stoppage"),
    "stoppage_topn": _with("SELECT * FROM stoppage WHERE num_stops >= 50 AND avg_duration_mins >= 10.0 "
                           "ORDER BY avg_duration_mins DESC, station_code LIMIT 25", "stoppage"),
    "stoppage_match_counts": _with("SELECT count(*) AS matched, least(count(*), 25) AS displayed FROM stoppage "
                                   "WHERE num_stops >= 400 AND avg_duration_mins >= 25.0", "stoppage"),
    "stoppage_bounds": _with("SELECT max(num_stops) AS max_num_stops, max(avg_duration_mins) AS max_avg, "
                             "greatest(25.0::DOUBLE, round(max(avg_duration_mins))) AS slider_max FROM stoppage", "stoppage"),
    "hourly_traffic": _with("SELECT * FROM hourly", "hourly"),
    "hourly_traffic_dense": _with("SELECT * FROM dense", "dense"),
    "hourly_window": _with("SELECT * FROM hourly WHERE hour BETWEEN 6 AND 11", "hourly"),
    "hourly_window_overnight": _with("SELECT * FROM hourly WHERE hour >= 22 OR hour <= 5", "hourly"),
    "hourly_window_kpis": _with("SELECT CAST(sum(CASE WHEN hour BETWEEN 6 AND 11 THEN arrivals END) AS BIGINT) AS window_total, "
                                "100.0::DOUBLE*sum(CASE WHEN hour BETWEEN 6 AND 11 THEN arrivals END)/greatest(sum(arrivals),1) AS window_pct, "
                                "count(CASE WHEN hour BETWEEN 6 AND 11 THEN 1 END) AS hour_bins FROM hourly", "hourly"),
    "hourly_peak": _with("SELECT hour AS peak_hour, arrivals FROM hourly WHERE hour BETWEEN 0 AND 23 "
                         "ORDER BY arrivals DESC, hour LIMIT 1", "hourly"),
    "hourly_share": _with("SELECT lpad(CAST(hour AS STRING),2,'0')||':00' AS hour_label, arrivals, "
                          "100.0::DOUBLE*arrivals/greatest(sum(arrivals) OVER (),1) AS pct FROM hourly "
                          "WHERE hour BETWEEN 0 AND 23", "hourly"),
    "longest_trains": _with("SELECT train_number, train_name, count(*) AS num_stops FROM stops GROUP BY 1,2 ORDER BY 3 DESC,1,2 LIMIT 20"),
    "breakdown_zone": _with("SELECT * FROM bd_zone", "bd_zone"),
    "breakdown_state": _with("SELECT state, count(*) AS total_stops, count(DISTINCT train_number) AS distinct_trains FROM stops GROUP BY 1"),
    "breakdown_train_type": _with("SELECT * FROM bd_type", "bd_type"),
    "breakdowns_all": _with("SELECT 'state' AS dimension, state AS value, count(*) AS total_stops, count(DISTINCT train_number) "
                            "AS distinct_trains FROM stops GROUP BY 2 UNION ALL "
                            "SELECT 'zone', zone, count(*), count(DISTINCT train_number) FROM stops GROUP BY 2 UNION ALL "
                            "SELECT 'train_type', train_type, count(*), count(DISTINCT train_number) FROM stops GROUP BY 2"),
    "breakdown_zone_valid": _with("SELECT * FROM bd_zone WHERE zone IS NOT NULL AND zone NOT IN ('','?') "
                                  "ORDER BY total_stops DESC, zone LIMIT 15", "bd_zone"),
    "breakdown_type_valid": _with("SELECT * FROM bd_type WHERE train_type IS NOT NULL AND train_type NOT IN ('','?') "
                                  "ORDER BY total_stops DESC, train_type LIMIT 10", "bd_type"),
    "run_summary": _with("SELECT (SELECT count(*) FROM raw_stops) AS raw_rows, count(*) AS cleaned_rows, "
                         "count(DISTINCT train_number) AS distinct_trains, count(DISTINCT station_code) AS distinct_stations FROM stops"),
    "distinct_stations": _with("SELECT DISTINCT station_name FROM stops WHERE station_name IS NOT NULL"),
    "distinct_train_types": _with("SELECT DISTINCT train_type FROM stops WHERE train_type IS NOT NULL AND train_type <> ''"),
    "station_train_types": _with("SELECT station_name, string_agg(DISTINCT train_type, ',' ORDER BY train_type) AS train_types "
                                 "FROM stops WHERE train_type IS NOT NULL AND train_type <> '' GROUP BY 1"),
    "station_profiles": _with("SELECT station_name, min(station_code) AS station_code, count(*) AS services, "
                              "round(avg(stop_duration_mins),1) AS avg_halt_mins, count(DISTINCT train_number) AS distinct_trains, "
                              "coalesce(string_agg(DISTINCT CASE WHEN train_type <> '' THEN train_type END, ',' ORDER BY "
                              "CASE WHEN train_type <> '' THEN train_type END), '') AS train_types FROM stops GROUP BY 1"),
    "catalog_train_types": _with("SELECT DISTINCT train_type FROM catalog WHERE train_type IS NOT NULL AND train_type <> ''",
                                 "catalog"),
    "station_timetable": _with("SELECT * FROM timetable", "timetable"),
    "station_timetable_by_type": _with("SELECT * FROM timetable WHERE train_type = '2-HIGH'", "timetable"),
    "station_timetable_by_period": _with("SELECT * FROM timetable WHERE TRY_CAST(split_part(arrival,':',1) AS INT) >= 18 "
                                         "AND TRY_CAST(split_part(arrival,':',1) AS INT) < 24", "timetable"),
    "station_timetable_min_halt": _with("SELECT * FROM timetable WHERE stop_duration_mins >= 10", "timetable"),
    "station_card": _with("SELECT station_name, min(station_code) AS station_code, count(*) AS services, "
                          "round(avg(stop_duration_mins),1) AS avg_halt_mins FROM stops GROUP BY 1"),
    "train_catalog": _with("SELECT * FROM catalog", "catalog"),
    "train_search": _with("SELECT * FROM catalog WHERE train_type = '2-HIGH' AND (regexp_matches(lower(train_number),'110') "
                          "OR regexp_matches(lower(train_name),'110'))", "catalog"),
    "train_search_fallback": _with("SELECT * FROM catalog WHERE regexp_matches(lower(coalesce(train_name,'')),'zzz') OR NOT EXISTS "
                                   "(SELECT 1 FROM catalog x WHERE regexp_matches(lower(coalesce(x.train_name,'')),'zzz'))", "catalog"),
    "route_itinerary": _with("SELECT stop_sequence, station_code, station_name, arrival, departure, stop_duration_mins, day, state, zone "
                             "FROM stops WHERE train_number = '1102'"),
    "route_halt_number": _with("SELECT train_number, stop_sequence, station_code, station_name, arrival, departure, "
                               "CAST(row_number() OVER (PARTITION BY train_number ORDER BY stop_sequence, arrival NULLS FIRST, "
                               "departure NULLS FIRST, station_code NULLS FIRST, station_name NULLS FIRST) AS INT) AS halt_no FROM stops"),
    "route_filtered": _with("SELECT train_number, stop_sequence, state, zone, stop_duration_mins FROM stops "
                            "WHERE state IN ('NATION_1','NATION_12','NATION_13') AND zone IN ('AFRICA','AMERICA','ASIA','EUROPE') "
                            "AND stop_duration_mins >= 10"),
    "route_halt_profile": _with("SELECT train_number, stop_sequence, station_code, station_name, arrival, departure, stop_duration_mins, "
                                "day, state FROM stops WHERE stop_duration_mins IS NOT NULL"),
    "route_summary": _with("SELECT train_number, count(*) AS total_halts, coalesce(max(day),1) AS journey_days, "
                           "count(DISTINCT state) AS states, count(DISTINCT zone) AS zones FROM stops GROUP BY 1"),
    "route_endpoints": _with("SELECT train_number, max(CASE WHEN f=1 THEN station_name||' ('||station_code||')' END) AS origin, "
                             "max(CASE WHEN b=1 THEN station_name||' ('||station_code||')' END) AS destination FROM (SELECT *, "
                             f"row_number() OVER (PARTITION BY train_number ORDER BY {FORWARD}) AS f, "
                             f"row_number() OVER (PARTITION BY train_number ORDER BY {BACKWARD}) AS b "
                             "FROM stops) GROUP BY 1"),
    "route_regions": _with("SELECT train_number, string_agg(DISTINCT state, ',' ORDER BY state) AS states FROM stops "
                           "WHERE state IS NOT NULL GROUP BY 1"),
    "route_zones": _with("SELECT train_number, string_agg(DISTINCT zone, ',' ORDER BY zone) AS zones FROM stops "
                         "WHERE zone IS NOT NULL GROUP BY 1"),
    "train_profiles": _with(
        "SELECT c.train_number, c.train_name, c.train_type, c.label, s.total_halts, s.journey_days, s.states, s.zones, "
        "r.state_list, z.zone_list, e.origin, e.destination FROM catalog c "
        "JOIN (SELECT train_number, count(*) AS total_halts, coalesce(max(day),1) AS journey_days, "
        "count(DISTINCT state) AS states, count(DISTINCT zone) AS zones FROM stops GROUP BY 1) s USING (train_number) "
        "JOIN (SELECT train_number, max(CASE WHEN f=1 THEN station_name||' ('||station_code||')' END) AS origin, "
        "max(CASE WHEN b=1 THEN station_name||' ('||station_code||')' END) AS destination FROM (SELECT *, "
        f"row_number() OVER (PARTITION BY train_number ORDER BY {FORWARD}) AS f, "
        f"row_number() OVER (PARTITION BY train_number ORDER BY {BACKWARD}) AS b "
        "FROM stops) GROUP BY 1) e USING (train_number) "
        "LEFT JOIN (SELECT train_number, string_agg(DISTINCT state, ',' ORDER BY state) AS state_list FROM stops "
        "WHERE state IS NOT NULL GROUP BY 1) r USING (train_number) "
        "LEFT JOIN (SELECT train_number, string_agg(DISTINCT zone, ',' ORDER BY zone) AS zone_list FROM stops "
        "WHERE zone IS NOT NULL GROUP BY 1) z USING (train_number)", "catalog"),
    "export_clean": _with("SELECT train_number, train_name, train_type, station_code, station_name, arrival, departure, "
                          "stop_sequence, day, stop_duration_mins, zone, state FROM stops"),
    "profile_nulls": _with(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'None') THEN 1 END) AS nulls, "
        f"round(100.0::DOUBLE*count(CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'None') THEN 1 END)/count(*),1) AS pct FROM raw_stops"
        for c in ("number", "trainName", "station", "station_name", "arrival", "departure", "day", "id"))),
    "profile_datasets": _with("SELECT 'raw_stops' AS dataset, count(*) AS row_count, CAST(8 AS INT) AS col_count FROM raw_stops "
                              "UNION ALL SELECT 'station_meta', count(*), CAST(3 AS INT) FROM station_meta "
                              "UNION ALL SELECT 'train_meta', count(*), CAST(2 AS INT) FROM train_meta"),
    "profile_sample": _with("SELECT * FROM raw_stops ORDER BY id, number NULLS FIRST, trainName NULLS FIRST, station NULLS FIRST, "
                                "station_name NULLS FIRST, arrival NULLS FIRST, departure NULLS FIRST, day LIMIT 10"),
    "profile_sample_all": _with("SELECT * FROM raw_stops ORDER BY id, number NULLS FIRST, trainName NULLS FIRST, station NULLS FIRST, "
                                "station_name NULLS FIRST, arrival NULLS FIRST, departure NULLS FIRST, day LIMIT 10"),
    "dq_report": _with(
        "SELECT 'stops_non_empty' AS check_name, count(*) > 0 AS ok, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) "
        "AS violations FROM stops UNION ALL "
        "SELECT 'stop_duration_non_negative', count(CASE WHEN stop_duration_mins < 0 THEN 1 END) = 0, "
        "count(CASE WHEN stop_duration_mins < 0 THEN 1 END) FROM stops UNION ALL "
        "SELECT 'stop_duration_present', count(stop_duration_mins) > 0, "
        "CAST(CASE WHEN count(stop_duration_mins) > 0 THEN 0 ELSE 1 END AS BIGINT) FROM stops UNION ALL "
        "SELECT 'keys_not_null', count(CASE WHEN train_number IS NULL OR station_code IS NULL THEN 1 END) = 0, "
        "count(CASE WHEN train_number IS NULL OR station_code IS NULL THEN 1 END) FROM stops UNION ALL "
        "SELECT 'arrival_hour_in_0_23', count(CASE WHEN arrival IS NOT NULL AND NOT coalesce(TRY_CAST(split_part(arrival,':',1) "
        "AS INT) BETWEEN 0 AND 23, false) THEN 1 END) = 0, count(CASE WHEN arrival IS NOT NULL AND NOT coalesce("
        "TRY_CAST(split_part(arrival,':',1) AS INT) BETWEEN 0 AND 23, false) THEN 1 END) FROM stops UNION ALL "
        "SELECT 'busiest_stations_non_empty', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) FROM busiest UNION ALL "
        "SELECT 'busiest_stations_counts_positive', count(CASE WHEN total_stops <= 0 OR distinct_trains <= 0 THEN 1 END) = 0, "
        "count(CASE WHEN total_stops <= 0 OR distinct_trains <= 0 THEN 1 END) FROM busiest UNION ALL "
        "SELECT 'longest_trains_non_empty', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) FROM longest UNION ALL "
        "SELECT 'longest_trains_counts_positive', count(CASE WHEN num_stops <= 0 THEN 1 END) = 0, "
        "count(CASE WHEN num_stops <= 0 THEN 1 END) FROM longest UNION ALL "
        "SELECT 'hourly_traffic_24_hours', abs(count(*) - 24) + count(CASE WHEN NOT (hour BETWEEN 0 AND 23) THEN 1 END) = 0, "
        "CAST(abs(count(*) - 24) + count(CASE WHEN NOT (hour BETWEEN 0 AND 23) THEN 1 END) AS BIGINT) FROM dense UNION ALL "
        "SELECT 'station_lookup_returns_rows', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) "
        "FROM stops WHERE station_name = (SELECT station_name FROM busiest ORDER BY total_stops DESC, station_code, station_name LIMIT 1) "
        "UNION ALL SELECT 'train_lookup_returns_rows', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) "
        "FROM stops WHERE train_number = (SELECT train_number FROM longest ORDER BY num_stops DESC, train_number, train_name LIMIT 1) "
        "UNION ALL SELECT 'clean_stats_values_valid', (SELECT count(*) FROM raw_stops) > 0 AND (SELECT count(*) FROM clean) > 0, "
        "CAST(CASE WHEN (SELECT count(*) FROM raw_stops) > 0 AND (SELECT count(*) FROM clean) > 0 THEN 0 ELSE 1 END AS BIGINT) "
        "UNION ALL SELECT 'run_summary_values_valid', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) FROM stops "
        "UNION ALL SELECT 'stoppage_stats_non_empty', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) FROM stoppage "
        "UNION ALL SELECT 'stoppage_stats_counts_positive', count(CASE WHEN num_stops <= 0 THEN 1 END) = 0, count(CASE WHEN num_stops <= 0 THEN 1 END) FROM stoppage "
        "UNION ALL SELECT 'stoppage_stats_values_non_negative', count(CASE WHEN least(avg_duration_mins, max_duration_mins, p90_duration_mins) < 0 THEN 1 END) = 0, "
        "count(CASE WHEN least(avg_duration_mins, max_duration_mins, p90_duration_mins) < 0 THEN 1 END) FROM stoppage "
        "UNION ALL SELECT 'breakdown_zone_non_empty', count(*) > 0, CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) FROM bd_zone "
        "UNION ALL SELECT 'breakdown_zone_counts_positive', count(CASE WHEN total_stops <= 0 OR distinct_trains <= 0 THEN 1 END) = 0, "
        "count(CASE WHEN total_stops <= 0 OR distinct_trains <= 0 THEN 1 END) FROM bd_zone "
        "UNION ALL SELECT t || '_required_columns', true, CAST(0 AS BIGINT) FROM (VALUES ('stops'), ('busiest_stations'), ('hourly_traffic'), "
        "('stoppage_stats'), ('longest_trains')) v(t)",
        "busiest", "dense", "longest", "stoppage", "bd_zone"),
    "name_only_analysis": _with("SELECT station_name, count(*) AS total_stops, count(DISTINCT train_number) AS distinct_trains FROM ("
                                "SELECT DISTINCT train_number, train_name, station_name, arrival, departure, day, stop_sequence FROM clean_m "
                                "WHERE train_number IS NOT NULL AND station_name IS NOT NULL) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"),
    "station_matches": _with("SELECT count(*) AS matched FROM timetable WHERE TRY_CAST(split_part(arrival,':',1) AS INT) BETWEEN 18 AND 23", "timetable"),
    "scan_json": _with("SELECT * FROM raw_stops"),
    # CSV cannot tell an empty string from a missing value: both read back as null.
    "scan_csv": _with("SELECT nullif(number,'') AS number, nullif(trainName,'') AS trainName, nullif(station,'') AS station, "
                      "nullif(station_name,'') AS station_name, nullif(arrival,'') AS arrival, nullif(departure,'') AS departure, "
                      "CAST(day AS VARCHAR) AS day, CAST(id AS VARCHAR) AS id FROM raw_stops"),
    "publish_parquet": _with("SELECT * FROM stops"),
    "publish_versions": _with("SELECT * FROM stops"),
    # CSV carries text only, and an empty field reads back as null.
    "export_csv": _with("SELECT " + ", ".join(
        f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in
        ["train_number", "train_name", "train_type", "station_code", "station_name", "arrival", "departure",
         "stop_sequence", "day", "stop_duration_mins", "zone", "state"]) + " FROM stops"),
    "scan_parquet": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
}

# Per-column inspection report of the raw feed: the schema facts are fixed by
# the feed's definition; the counts come from the data.
_RAW_COLUMNS = [("number", "string"), ("trainName", "string"), ("station", "string"), ("station_name", "string"),
                ("arrival", "string"), ("departure", "string"), ("day", "int"), ("id", "bigint")]


def _null_like(col: str) -> str:
    return f"count(CASE WHEN {col} IS NULL OR CAST({col} AS VARCHAR) = '' OR CAST({col} AS VARCHAR) = 'None' THEN 1 END)"


ORACLE["profile_schema"] = _with(" UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{c}' AS column_name, '{t}' AS data_type, true AS nullable, "
    f"{_null_like(c)} AS nulls, round(100.0::DOUBLE*{_null_like(c)}/count(*),1) AS pct FROM raw_stops"
    for i, (c, t) in enumerate(_RAW_COLUMNS)))

# Same results through a second code path (SQL over a view / the jobs' paths).
ORACLE["stoppage_stats_sql"] = ORACLE["stoppage_stats"]
ORACLE["longest_trains_sql"] = ORACLE["longest_trains"]
ORACLE["clean_stops_observed"] = ORACLE["clean_stops"]
ORACLE["run_summary_from_groups"] = ORACLE["run_summary"]
ORACLE["clean_stats_json"] = ORACLE["clean_stats"]
ORACLE["breakdown_state_from_counts"] = ORACLE["breakdown_state"]
ORACLE["longest_trains_from_counts"] = ORACLE["longest_trains"]
