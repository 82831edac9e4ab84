"""Independent SQL for every registered query (DuckDB dialect).

The driver tables are registered as views under their own names.  Column
names and types match the Spark results.
"""

from __future__ import annotations

TAB = "chr(9)"

GKG = """gkg AS (
  SELECT strftime(o.o_orderdate, '%Y%m%d%H%M%S') || '-' || CAST(o.o_orderkey AS VARCHAR) AS record_id,
         o.o_orderdate AS record_time,
         CAST(o.o_orderdate AS DATE) AS day,
         n.all_names
  FROM (SELECT l.l_orderkey,
               string_agg(p.p_name || ',' || CAST(l.l_linenumber AS VARCHAR), ';'
                          ORDER BY l.l_linenumber, p.p_name || ',' || CAST(l.l_linenumber AS VARCHAR))
                 AS all_names
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
        GROUP BY l.l_orderkey) n
  JOIN orders o ON o.o_orderkey = n.l_orderkey)"""


def _java_split(expr: str, sep: str, sep_re: str) -> str:
    trimmed = f"regexp_replace({expr}, '(?:{sep_re})+$', '')"
    return (f"CASE WHEN {expr} = '' THEN [''] WHEN {trimmed} = '' THEN []::VARCHAR[] "
            f"ELSE string_split({trimmed}, '{sep}') END")


def _mentions(stop_where: str = "topic <> 'Type ParentCategory'") -> str:
    arr = _java_split("s", ";", ";")
    return f"""mentions AS (
  SELECT day, topic FROM (
    SELECT day, unnest({arr}) AS topic
    FROM (SELECT day, regexp_replace(all_names, '[,0-9]', '', 'g') AS s FROM gkg
          WHERE day IS NOT NULL AND all_names IS NOT NULL) t) u
  WHERE {stop_where})"""


COUNTS = """counts AS (SELECT day, topic, count(*) AS "count" FROM mentions GROUP BY day, topic)"""

TOP10 = """top10 AS (
  SELECT day, topic, "count" FROM (
    SELECT day, topic, "count", rank() OVER (PARTITION BY day ORDER BY "count" DESC) AS r FROM counts) x
  WHERE r <= 10)"""


def _pieces(arr: str) -> str:
    return (f"SELECT doc_id, generate_subscripts(arr, 1) - 1 AS pos, unnest(arr) AS piece "
            f"FROM (SELECT doc_id, {arr} AS arr FROM documents WHERE text IS NOT NULL) d")


def _parse(expr: str, part: int) -> str:
    a = f"string_split({expr}, '-')[1]"
    b = f"string_split({expr}, '-')[2]"
    ok = (f"len(string_split({expr}, '-')) = 2 AND regexp_full_match({a}, '[+-]?[0-9]+') "
          f"AND regexp_full_match({b}, '[+-]?[0-9]+') AND TRY_CAST({a} AS BIGINT) IS NOT NULL "
          f"AND TRY_CAST({b} AS BIGINT) IS NOT NULL")
    val = a if part == 1 else b
    return f"CASE WHEN {ok} THEN TRY_CAST({val} AS BIGINT) ELSE 0 END"


def _last_closed(ts: str) -> str:
    return f"(date_trunc('minute', {ts}) - to_minutes(15 + minute({ts}) % 15))"


def _file_name(ts: str) -> str:
    return f"(strftime({ts}, '%Y%m%d%H%M') || '00.gkg.csv')"


CATALOGUE = f"""catalogue AS (
  SELECT segment_start, {_file_name('segment_start')} AS file_name FROM (
    SELECT unnest(CASE WHEN first <= last THEN generate_series(first, last, INTERVAL 15 MINUTES)
                       ELSE []::TIMESTAMP[] END) AS segment_start
    FROM (SELECT {_last_closed('now')} AS last, time_bucket(INTERVAL 15 MINUTES, lo) AS first
          FROM (SELECT max(ts) AS now, min(ts) AS lo FROM events) s) b) c)"""

EVENT_LINES = f"""lines AS (
  SELECT {_file_name("time_bucket(INTERVAL 15 MINUTES, ts)")} AS file_name,
         concat_ws({TAB}, strftime(time_bucket(INTERVAL 15 MINUTES, ts), '%Y%m%d%H%M') || '00-'
                          || CAST(event_id AS VARCHAR),
                   event_type, CAST(user_id AS VARCHAR), coalesce(props, '')) AS value,
         event_id AS seq
  FROM events)"""

SPREAD = f"""{EVENT_LINES},
keyed AS (SELECT *, split_part(value, {TAB}, 1) AS key FROM lines),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY seq, key) - 1 AS line_index,
         count(*) OVER (PARTITION BY file_name) AS n_lines,
         first_value(key) OVER (PARTITION BY file_name ORDER BY seq, key) AS first_key
  FROM keyed),
spread AS (
  SELECT file_name, key, value, seq, line_index, n_lines,
         strptime(substr(first_key, 1, 12), '%Y%m%d%H%M')
           + to_milliseconds(line_index * (900000 // n_lines)) AS event_time
  FROM numbered)"""

GKG_LINE = "concat_ws({tab}, record_id, strftime(record_time, '%Y%m%d%H%M%S'), '1', {empties20}, " \
           "coalesce(all_names, ''), '', '', '')".format(tab=TAB, empties20=", ".join(["''"] * 20))

CHANGES = """changes AS (
  SELECT event_type AS name, ts, event_id, 1 AS delta FROM events WHERE ts IS NOT NULL
  UNION ALL
  SELECT event_type AS name, ts + INTERVAL 1 HOUR AS ts, event_id, -1 AS delta FROM events
  WHERE ts IS NOT NULL),
changelog AS (
  SELECT name, ts, event_id, delta,
         CAST(sum(delta) OVER (PARTITION BY name ORDER BY ts, delta DESC, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "count"
  FROM changes)"""

USER_HIST = """(SELECT CAST(user_id AS VARCHAR) AS name, count(*) AS "count" FROM {src} GROUP BY 1)"""


def _top100(src: str) -> str:
    return (f"(SELECT name, \"count\" FROM {USER_HIST.format(src=src)} h "
            f"ORDER BY \"count\" DESC, name ASC LIMIT 100)")


SNAPSHOTS = f"""span AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
early_events AS (SELECT * FROM events
                 WHERE CAST(ts AS DATE) <= (SELECT lo + CAST((hi - lo) // 2 AS INTEGER) FROM span)),
earlier AS {_top100('early_events')},
later AS {_top100('events')},
delta AS (
  SELECT coalesce(c.name, p.name) AS name, CAST(coalesce(c."count", 0) AS BIGINT) AS "count"
  FROM earlier p FULL OUTER JOIN later c ON p.name = c.name
  WHERE c."count" IS NULL OR p."count" IS NULL OR c."count" <> p."count")"""


STREAM_NAMES = r"""named AS (
  SELECT name, ts FROM (
    SELECT regexp_replace(event_type, '[,0-9]', '', 'g') AS name, ts FROM events
    WHERE event_type IS NOT NULL AND ts IS NOT NULL) n
  WHERE NOT regexp_matches(name, '^[\x00-\x20]*$'))"""

ORACLE_SQL: dict[str, str] = {
    "gkg_scan": f"WITH {GKG} SELECT day, all_names FROM gkg "
                "WHERE day IS NOT NULL AND all_names IS NOT NULL",
    "gkg_line_scan": f"WITH {GKG} SELECT strftime(day, '%Y-%m-%d') AS day, all_names FROM gkg",
    "strip_names": "SELECT doc_id, regexp_replace(text, '[,0-9]', '', 'g') AS stripped FROM documents",
    "java_split": _pieces(_java_split("text", ".", r"\.")),
    "split_all": _pieces("string_split(text, '.')"),
    "nonblank_topics": f"SELECT * FROM ({_pieces("string_split(text, '.')")}) p "
                       r"WHERE NOT regexp_matches(piece, '^[\x00-\x20]*$')",
    "topic_mentions": f"WITH {GKG}, {_mentions()} SELECT day, topic FROM mentions",
    "stop_topic_equals": f"WITH {GKG}, {_mentions("topic <> 'red plate'")} SELECT day, topic FROM mentions",
    "stop_topic_contains": f"WITH {GKG}, {_mentions("NOT contains(topic, 'plate')")} "
                           "SELECT day, topic FROM mentions",
    "topic_day_counts": f"WITH {GKG}, {_mentions()}, {COUNTS} SELECT day, topic, \"count\" FROM counts",
    "daily_top10": f"WITH {GKG}, {_mentions()}, {COUNTS}, {TOP10} SELECT day, topic, \"count\" FROM top10",
    "daily_top10_exact": f"""WITH {GKG}, {_mentions()}, {COUNTS}
        SELECT day, topic, "count" FROM (
          SELECT day, topic, "count",
                 row_number() OVER (PARTITION BY day ORDER BY "count" DESC, topic ASC) AS r
          FROM counts) x WHERE r <= 10""",
    "daily_top10_json": f"""WITH {GKG}, {_mentions()}, {COUNTS}, {TOP10}
        SELECT CAST(to_json({{'data': day,
                         'result': list({{'topic': topic, 'count': "count"}}
                                        ORDER BY "count" DESC, topic ASC)}}) AS VARCHAR) AS json
        FROM top10 GROUP BY day""",
    "daily_report_files": f"""WITH {GKG}, {_mentions()}, {COUNTS}, {TOP10}
        SELECT CAST(to_json({{'data': day,
                         'result': list({{'topic': topic, 'count': "count"}}
                                        ORDER BY "count" DESC, topic ASC)}}) AS VARCHAR) AS json
        FROM top10 GROUP BY day""",
    "daily_top10_lines": f"""WITH {GKG}, {_mentions("NOT contains(topic, 'Type ParentCategory')")},
        {COUNTS}
        SELECT strftime(day, '%Y-%m-%d') AS day, topic, "count" FROM (
          SELECT day, topic, "count",
                 row_number() OVER (PARTITION BY day ORDER BY "count" DESC, topic ASC) AS r
          FROM counts) x WHERE r <= 10""",
    "format_day": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text FROM orders",
    "parse_record_key": f"""
        SELECT o_orderkey, k AS record_key,
               TRY_CAST(split_part(k, '-', 1) AS BIGINT) AS key_head,
               {_parse('k', 1)} AS key_a, {_parse('k', 2)} AS key_b,
               TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS prio_head,
               {_parse('o_orderpriority', 1)} AS prio_a, {_parse('o_orderpriority', 2)} AS prio_b
        FROM (SELECT *, strftime(o_orderdate, '%Y%m%d%H%M%S') || '-' || CAST(o_orderkey AS VARCHAR) AS k
              FROM orders) o""",
    "next_quarter": """SELECT event_id, ts,
        date_trunc('hour', ts) + to_minutes(CAST(ceil((minute(ts) + 1) / 15.0) * 15 AS BIGINT))
          AS next_quarter FROM events""",
    "last_closed_segment": f"SELECT event_id, ts, {_last_closed('ts')} AS last_closed FROM events",
    "segment_catalogue": f"WITH {CATALOGUE} SELECT segment_start, file_name FROM catalogue",
    "segments_after_highwater": f"""WITH {CATALOGUE},
        hw AS (SELECT {_file_name("time_bucket(INTERVAL 15 MINUTES, make_timestamp("
                                  "(min(epoch_us(ts)) + max(epoch_us(ts))) // 2))")} AS hw FROM events)
        SELECT segment_start, file_name FROM catalogue WHERE file_name > (SELECT hw FROM hw)""",
    "segments_union": f"""WITH {GKG}, {EVENT_LINES}
        SELECT split_part(v, {TAB}, 1) AS key, v AS value FROM (SELECT {GKG_LINE} AS v FROM gkg) g
        UNION ALL
        SELECT split_part(value, {TAB}, 1) AS key, value FROM lines""",
    "spread_event_time": f"WITH {SPREAD} SELECT * FROM spread",
    "record_envelope": f"""WITH {SPREAD}
        SELECT split_part(value, {TAB}, 1) AS key, value, event_time AS timestamp, CAST(NULL AS INTEGER) AS partition
        FROM spread""",
    "last_record_key": f"""WITH {SPREAD}
        SELECT coalesce(arg_max(key, (event_time, seq)), '20150218230000-0') AS last_key FROM spread""",
    "timestamp_sequence": """
        SELECT o_orderkey, epoch_ms(o_orderdate) AS millis, seq,
               CAST(epoch_ms(o_orderdate) AS VARCHAR) || '-' || CAST(seq AS VARCHAR) AS log_key
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS seq
              FROM orders) o""",
    "trailing_hour_count": """
        SELECT event_id, event_type AS name, ts,
               count(*) OVER (PARTITION BY event_type ORDER BY ts
                              RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS "count"
        FROM events""",
    "trailing_hour_changelog": f"WITH {CHANGES} SELECT name, ts, event_id, delta, \"count\" FROM changelog",
    "coalesce_latest": f"""WITH {CHANGES}
        SELECT time_bucket(INTERVAL 15 MINUTES, ts) AS tick, name,
               arg_max("count", (ts, -delta, event_id)) AS "count"
        FROM changelog GROUP BY 1, 2""",
    "top100_current": f"SELECT * FROM {_top100('events')} t",
    "histogram_minimum": f"""SELECT arg_min(name, ("count", name)) AS name, min("count") AS "count"
        FROM {_top100('events')} t""",
    "top100_delta": f"WITH {SNAPSHOTS} SELECT name, \"count\" FROM delta",
    "snapshot_json": f"""WITH {SNAPSHOTS},
        snap AS (SELECT name, CAST("count" AS BIGINT) AS "count" FROM later
                 UNION ALL
                 SELECT name, CAST(0 AS BIGINT) FROM earlier WHERE name NOT IN (SELECT name FROM later))
        SELECT name, CAST(to_json({{'name': name, 'count': "count"}}) AS VARCHAR) AS json FROM snap""",
    "delta_json": f"""WITH {SNAPSHOTS}
        SELECT CAST(to_json(list({{'name': name, 'count': "count"}} ORDER BY name, "count")) AS VARCHAR) AS json
        FROM delta""",
    "stream_trailing_arrivals": f"""WITH {STREAM_NAMES},
        counted AS (
          SELECT name, ts, count(*) OVER (PARTITION BY name ORDER BY ts
                            RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS c
          FROM named)
        SELECT name, ts, CAST(count(*) AS BIGINT) AS delta, max(c) AS "count"
        FROM counted GROUP BY name, ts""",
    "stream_snapshot_totals": f"""WITH {STREAM_NAMES}
        SELECT name, count(*) AS "count" FROM named GROUP BY name""",
    "stream_trailing_changelog": f"""WITH {STREAM_NAMES},
        arrivals AS (SELECT name, ts, count(*) AS n FROM named GROUP BY name, ts),
        changes AS (
          SELECT name, ts, n AS delta, 0 AS kind FROM arrivals
          UNION ALL
          SELECT name, ts + INTERVAL 1 HOUR, -n, 1 FROM arrivals)
        SELECT name, ts, CAST(delta AS BIGINT) AS delta,
               CAST(sum(delta) OVER (PARTITION BY name ORDER BY ts, kind
                                     ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "count"
        FROM changes""",
    "stream_top100_totals": """WITH daily AS (
          SELECT translate(CAST(user_id AS VARCHAR), '0123456789', 'abcdefghij') AS name, CAST(ts AS DATE) AS d,
                 count(*) AS n
          FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
        batches AS (
          SELECT d, (dense_rank() OVER (ORDER BY d) - 1) // 8 AS b
          FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE ts IS NOT NULL) x),
        totals AS (
          SELECT e.b, name, sum(n) AS "count"
          FROM (SELECT DISTINCT b FROM batches) e JOIN batches x ON x.b <= e.b JOIN daily y ON y.d = x.d
          GROUP BY e.b, name),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY b ORDER BY "count" DESC, name) AS r FROM totals),
        final AS (SELECT name, "count" FROM ranked WHERE r <= 100 AND b = (SELECT max(b) FROM batches))
        SELECT s.name, CAST(coalesce(f."count", 0) AS BIGINT) AS "count"
        FROM (SELECT DISTINCT name FROM ranked WHERE r <= 100) s LEFT JOIN final f ON f.name = s.name""",
    "record_log_stream": f"""SELECT segment, partition, CAST(row_number() OVER (
                 PARTITION BY partition ORDER BY segment, timestamp, key, value) - 1 AS BIGINT) AS "offset",
               key, value, timestamp
        FROM (SELECT strftime(ts, '%Y-%m-%d') AS segment, CAST(event_id % 4 AS INTEGER) AS partition,
                     CAST(event_id AS VARCHAR) AS key, ts AS timestamp,
                     concat_ws({TAB}, CAST(event_id AS VARCHAR), {", ".join(["''"] * 22)},
                               coalesce(event_type || ',' || coalesce(CAST(user_id AS VARCHAR), ''), ''),
                               '', '', '') AS value
              FROM events WHERE ts IS NOT NULL) r""",
    "histogram_wire": """SELECT CAST(user_id AS VARCHAR) AS name, printf('%016X', count(*)) AS payload,
               count(*) AS "count" FROM events WHERE user_id IS NOT NULL GROUP BY user_id""",
    "tolerant_lines": "SELECT doc_id, source FROM documents WHERE source IS NOT NULL",
    "stream_sliding_hour": f"""WITH {STREAM_NAMES},
        per_minute AS (
          SELECT name, time_bucket(INTERVAL 1 MINUTE, ts) AS minute, count(*) AS n
          FROM named GROUP BY name, minute),
        spread AS (
          SELECT name, minute - to_minutes(k) AS start, n
          FROM per_minute, range(0, 60) r(k))
        SELECT start, start + INTERVAL 1 HOUR AS "end", name, CAST(sum(n) AS BIGINT) AS "count"
        FROM spread GROUP BY name, start""",
}

# rows in any order give the same log
ORACLE_SQL["stream_trailing_unordered"] = ORACLE_SQL["stream_trailing_changelog"]
# written as JSON lines and read back: the same rows
ORACLE_SQL["json_round_trip"] = ORACLE_SQL["daily_top10"]
