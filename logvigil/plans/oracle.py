"""The registered queries in DuckDB SQL, over the same ``events`` table.

Written on its own, apart from the operators: each text says what a query has to
return, in the plainest SQL.
"""

_VIEW = """
SELECT
  CASE WHEN event_id % 101 = 0 THEN 'not-a-time'
       WHEN event_id % 97 = 0 THEN NULL
       WHEN event_id % 2 = 0 THEN strftime({clock}, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime({clock}, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
  CASE WHEN event_id % 89 = 0 THEN NULL
       WHEN event_type IN ('click', 'view', 'error') AND event_id % 5 < 4
       THEN concat('10.0.0.', CAST(user_id % 5 AS VARCHAR))
       ELSE concat('10.1.', CAST(CAST((user_id - user_id % 256) / 256 AS BIGINT) AS VARCHAR),
                   '.', CAST(user_id % 256 AS VARCHAR)) END AS source_ip,
  concat('192.168.1.', CAST(event_id % 37 AS VARCHAR)) AS dest_ip,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN 'TCP'
       WHEN event_type = 'signup' THEN 'UDP' ELSE 'ICMP' END AS protocol,
  CASE WHEN event_id % 3 = 0 THEN 'blocked' ELSE 'allowed' END AS action,
  CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_type = 'error' THEN 'malicious'
       WHEN event_type = 'signup' THEN 'suspicious' ELSE 'benign' END AS threat_label,
  CASE event_id % 3 WHEN 0 THEN 'firewall' WHEN 1 THEN 'ids' ELSE 'application' END AS log_type,
  CASE WHEN event_id % 79 = 0 THEN NULL
       ELSE CAST(round(value * 100) AS BIGINT) END AS bytes_transferred,
  concat('agent/', CAST(event_id % 10 AS VARCHAR)) AS user_agent,
  CASE event_id % 23
    WHEN 0 THEN '/index.html'
    WHEN 1 THEN concat('/login?user=admin', chr(39), ' OR 1=1')
    WHEN 2 THEN '/search?q=<SCRIPT>alert(1)</script>'
    WHEN 3 THEN '/../../etc/passwd'
    WHEN 4 THEN '/products/7'
    WHEN 5 THEN '/item.php?id=3'
    WHEN 6 THEN '/api/v1/health'
    WHEN 7 THEN '/q?x=<img src=x onerror=eval(1)>'
    WHEN 8 THEN '/a?b=union select x'
    WHEN 9 THEN concat('/q?a=', chr(34), '>, ', chr(34), '<iframe src=x>')
    WHEN 10 THEN '/nmap'
    WHEN 11 THEN NULL
    WHEN 12 THEN concat('/probe/', string_split(concat(
      chr(39), ' or ;or 1=1;', chr(39), ' --;union select;drop table;insert into;sqlmap;', chr(39),
      ' and ;xp_cmdshell;information_schema;sleep(;benchmark(;1=1;', chr(39), ' or ', chr(39), '1', chr(39), '=', chr(39), '1;',
      '<script>;javascript:;onerror=;onload=;alert(;<img src;document.cookie;eval(;<iframe;onmouseover=;</script>;',
      'nikto;../;/etc/passwd;cmd.exe;/bin/bash;wget ;curl ;base64_decode;nmap;.php?id=;../../'), ';')
      [CAST(((event_id - 12) // 23) % 36 AS INT) + 1])
    ELSE concat('/static/', CAST(event_id AS VARCHAR)) END AS request_path
FROM events"""

_TIME = r"^\s*(\d{4}-\d{1,2}-\d{1,2})[T ](\d{1,2}:\d{1,2}:\d{1,2})"
_DATE = r"^\s*(\d+)-(\d+)-(\d+)(?:[ T]|\s*$)"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The signatures, spelled out here too, so that the operator is checked against another text.
_TYPE_OF = """CASE
    WHEN contains(lower({path}), ''' or ')
      OR contains(lower({path}), 'or 1=1')
      OR contains(lower({path}), ''' --')
      OR contains(lower({path}), 'union select')
      OR contains(lower({path}), 'drop table')
      OR contains(lower({path}), 'insert into')
      OR contains(lower({path}), 'sqlmap')
      OR contains(lower({path}), ''' and ')
      OR contains(lower({path}), 'xp_cmdshell')
      OR contains(lower({path}), 'information_schema')
      OR contains(lower({path}), 'sleep(')
      OR contains(lower({path}), 'benchmark(')
      OR contains(lower({path}), '1=1')
      OR contains(lower({path}), ''' or ''1''=''1') THEN 'SQLi'
    WHEN contains(lower({path}), '<script>')
      OR contains(lower({path}), 'javascript:')
      OR contains(lower({path}), 'onerror=')
      OR contains(lower({path}), 'onload=')
      OR contains(lower({path}), 'alert(')
      OR contains(lower({path}), '<img src')
      OR contains(lower({path}), 'document.cookie')
      OR contains(lower({path}), 'eval(')
      OR contains(lower({path}), '<iframe')
      OR contains(lower({path}), 'onmouseover=')
      OR contains(lower({path}), '</script>') THEN 'XSS'
    WHEN contains(lower({path}), 'nikto')
      OR contains(lower({path}), '../')
      OR contains(lower({path}), '/etc/passwd')
      OR contains(lower({path}), 'cmd.exe')
      OR contains(lower({path}), '/bin/bash')
      OR contains(lower({path}), 'wget ')
      OR contains(lower({path}), 'curl ')
      OR contains(lower({path}), 'base64_decode')
      OR contains(lower({path}), 'nmap')
      OR contains(lower({path}), '.php?id=')
      OR contains(lower({path}), '../../') THEN 'Other'
  END"""
_ATTACK_TYPE = _TYPE_OF.format(path="request_path")

# Named query parts; each builds on the ones before it.
_PARTS = {
    "logs": _VIEW.format(clock="TIMESTAMP '2024-05-01 00:00:00' + to_seconds(event_id * 7)"),
    "timed": f"""
SELECT *, TRY_CAST(regexp_extract("timestamp", '{_TIME}', 1) || ' '
                   || regexp_extract("timestamp", '{_TIME}', 2) AS TIMESTAMP) AS ts FROM logs""",
    "threats": "SELECT * FROM timed WHERE threat_label IN ('suspicious', 'malicious')",
    "protocol_ranks": """
SELECT source_ip, protocol, row_number() OVER (
         PARTITION BY source_ip ORDER BY count(*) DESC, protocol) AS place
FROM threats WHERE protocol IS NOT NULL GROUP BY source_ip, protocol""",
    "log_ranks": """
SELECT source_ip, log_type, row_number() OVER (
         PARTITION BY source_ip ORDER BY count(*) DESC, log_type) AS place
FROM threats WHERE log_type IS NOT NULL GROUP BY source_ip, log_type""",
    "scores": """
SELECT t.source_ip, t.total_events, t.malicious_count, t.suspicious_count,
       strftime(t.last_ts, '%Y-%m-%d %H:%M:%S') AS last_seen,
       p.protocol AS main_protocol, l.log_type AS log_source,
       CAST(t.malicious_count * 2 + t.suspicious_count AS BIGINT) AS threat_score
FROM (SELECT source_ip, count(*) AS total_events,
             count(*) FILTER (WHERE threat_label = 'malicious') AS malicious_count,
             count(*) FILTER (WHERE threat_label = 'suspicious') AS suspicious_count,
             max(ts) AS last_ts
      FROM threats GROUP BY source_ip) t
LEFT JOIN protocol_ranks p ON p.source_ip IS NOT DISTINCT FROM t.source_ip AND p.place = 1
LEFT JOIN log_ranks l ON l.source_ip IS NOT DISTINCT FROM t.source_ip AND l.place = 1""",
    "top_ips": "SELECT * FROM scores ORDER BY threat_score DESC, source_ip ASC NULLS LAST LIMIT 10",
    "sized": """
SELECT * FROM logs WHERE threat_label IS NOT NULL AND bytes_transferred IS NOT NULL""",
    "by_protocol": """
SELECT threat_label, protocol, count(*) AS event_count,
       CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes,
       round(avg(bytes_transferred), 2) AS avg_bytes
FROM sized GROUP BY threat_label, protocol""",
    "tagged": f"""
SELECT * FROM (SELECT *, {_ATTACK_TYPE} AS attack_type FROM timed
               WHERE request_path IS NOT NULL) WHERE attack_type IS NOT NULL""",
    "hits": """
SELECT attack_type, source_ip, count(*) AS hit_count,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen
FROM tagged GROUP BY attack_type, source_ip""",
    "top_hits": """
SELECT attack_type, source_ip, hit_count, last_seen
FROM (SELECT *, row_number() OVER (PARTITION BY attack_type
               ORDER BY hit_count DESC, source_ip ASC NULLS LAST) AS place FROM hits)
WHERE place <= 50""",
    "windows": """
SELECT source_ip, count(DISTINCT dest_ip) AS distinct_targets, count(*) AS total_connections,
       time_bucket(INTERVAL 5 MINUTES, ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end
FROM timed WHERE ts IS NOT NULL AND protocol = 'TCP'
GROUP BY source_ip, time_bucket(INTERVAL 5 MINUTES, ts)""",
    "scans": "SELECT * FROM windows WHERE distinct_targets >= 5",
    "summary": """
SELECT source_ip, count(*) AS scan_windows,
       CAST(sum(distinct_targets) AS BIGINT) AS total_distinct_targets,
       max(window_end) AS last_seen
FROM scans GROUP BY source_ip""",
    "timeline": """
SELECT strftime(ts, '%Y-%m-%d-%H') AS hour_bucket,
       count(*) FILTER (WHERE threat_label = 'malicious') AS malicious,
       count(*) FILTER (WHERE threat_label = 'suspicious') AS suspicious,
       count(*) FILTER (WHERE threat_label = 'benign') AS benign,
       count(*) AS total
FROM timed WHERE ts IS NOT NULL GROUP BY hour_bucket""",
    "profile": f"""
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE threat_label IN ('suspicious', 'malicious')) AS threat_rows,
       count(*) FILTER (WHERE threat_label IS NOT NULL
                        AND bytes_transferred IS NOT NULL) AS sized_rows,
       count(*) FILTER (WHERE request_path IS NOT NULL) AS path_rows,
       count(*) FILTER (WHERE {_ATTACK_TYPE} IS NOT NULL) AS attack_rows,
       count(*) FILTER (WHERE ts IS NOT NULL) AS timed_rows,
       count(*) FILTER (WHERE ts IS NOT NULL AND protocol = 'TCP') AS tcp_rows,
       (SELECT count(*) FROM scans) AS scan_rows
FROM timed""",
    "raw": _VIEW.format(clock="ts"),
    "raw_days": f"""
SELECT *, regexp_extract("timestamp", '{_DATE}', 1) AS "year",
       regexp_extract("timestamp", '{_DATE}', 2) AS "month",
       regexp_extract("timestamp", '{_DATE}', 3) AS "day",
       coalesce(regexp_matches("timestamp", '{_DATE}'), false) AS has_date FROM raw""",
}


def _cells(rows: str, key: str, qualifiers: list[str], required: list[str]) -> str:
    """One branch per cell."""
    has_key = " AND ".join(f"{name} IS NOT NULL" for name in required)
    return " UNION ALL ".join(
        f"SELECT {key} AS row_key, 'cf' AS family, '{name}' AS qualifier, "
        f"coalesce(CAST({name} AS VARCHAR), '') AS value FROM {rows} WHERE {has_key}"
        for name in qualifiers
    )


_IP_CELLS = _cells(
    "top_ips",
    "source_ip",
    [
        "threat_score",
        "malicious_count",
        "suspicious_count",
        "total_events",
        "last_seen",
        "main_protocol",
        "log_source",
    ],
    ["source_ip"],
)
_ATTACK_CELLS = _cells(
    "top_hits",
    "attack_type || '#' || source_ip",
    ["attack_type", "source_ip", "hit_count", "last_seen"],
    ["attack_type", "source_ip"],
)
_HOUR_CELLS = _cells(
    "timeline", "hour_bucket", ["malicious", "suspicious", "benign", "total"], ["hour_bucket"]
)


def _sql(final: str, **more: str) -> str:
    parts = _PARTS | more
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts.items()) + final


_LOG_COLUMNS = (
    '"timestamp", source_ip, dest_ip, protocol, action, threat_label, log_type, '
    "bytes_transferred, user_agent, request_path"
)
_SORTED_HITS = " ORDER BY attack_type, hit_count DESC, source_ip NULLS LAST"
_SORTED_SCANS = " ORDER BY distinct_targets DESC, source_ip NULLS LAST, window_start"
_SORTED_SUMMARY = " ORDER BY scan_windows DESC, source_ip NULLS LAST"
_SORTED_VOLUME = " ORDER BY threat_label, total_bytes DESC, protocol NULLS LAST"


# Two loads of the timeline: that of the later one counts where both have an hour.
_LOADS = {
    f"load_{n}": "SELECT strftime(ts, '%Y-%m-%d-%H') AS hour_bucket,"
    + ", ".join(f"count(*) FILTER (WHERE threat_label = '{x}') AS {x}" for x in ("malicious", "suspicious", "benign"))
    + f", count(*) AS total FROM timed_events WHERE ts IS NOT NULL AND {where} GROUP BY hour_bucket"
    for n, where in ((1, "event_id % 3 < 2"), (2, "event_id % 3 > 0"))
}
_HOUR_COLUMNS = ["malicious", "suspicious", "benign", "total"]
_UPSERT = _sql(
    """ SELECT row_key, family, qualifier, value FROM cells_2
UNION ALL SELECT row_key, family, qualifier, value FROM cells_1
WHERE row_key NOT IN (SELECT row_key FROM cells_2)""",
    logs_with_id=_PARTS["logs"].replace("SELECT", "SELECT event_id,", 1),
    timed_events=_PARTS["timed"].replace("FROM logs", "FROM logs_with_id"),
    **_LOADS,
    cells_1=_cells("load_1", "hour_bucket", _HOUR_COLUMNS, ["hour_bucket"]),
    cells_2=_cells("load_2", "hour_bucket", _HOUR_COLUMNS, ["hour_bucket"]),
)

# The checks and what to do if one fails.
_ADVICE = {
    "total_rows": "no log line was read: check the path and that the ingest ran",
    "threat_rows": "no threat label among the lines: look at the labels in use",
    "sized_rows": "no line has both a threat label and a byte count: look at the labels in use",
    "path_rows": "no line has a request path: check the input",
    "attack_rows": "no signature in any request path: look at some paths",
    "timed_rows": "no line has a valid time: check the time format",
    "tcp_rows": "no TCP line with a valid time: look at the protocols in use",
    "scan_rows": "no window reaches the scan threshold: look at the most targets in any window",
}

ORACLE_SQL: dict[str, str] = {
    "top_malicious_ips": _sql(" SELECT * FROM top_ips"),
    "source_scores": _sql(" SELECT * FROM scores"),
    "threat_score_range": _sql(
        " SELECT max(threat_score) AS max_score, min(threat_score) AS min_score FROM top_ips"
    ),
    "threat_volume": _sql(
        """
SELECT threat_label, count(*) AS event_count,
       CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes,
       round(avg(bytes_transferred), 2) AS avg_bytes,
       max(bytes_transferred) AS max_bytes, min(bytes_transferred) AS min_bytes,
       quantile_disc(bytes_transferred, 0.95) AS p95_bytes
FROM sized GROUP BY threat_label ORDER BY threat_label"""
    ),
    "threat_volume_by_protocol": _sql(" SELECT * FROM by_protocol" + _SORTED_VOLUME),
    "threat_volume_preview": _sql(" SELECT * FROM by_protocol" + _SORTED_VOLUME + " LIMIT 40"),
    "distinct_threat_labels": _sql(" SELECT DISTINCT threat_label FROM logs"),
    "attack_tagged": _sql(" SELECT source_ip, request_path, attack_type FROM tagged"),
    "attack_totals": _sql(
        " SELECT attack_type, count(*) AS hit_count FROM tagged GROUP BY attack_type"
    ),
    "attack_patterns_of_samples": _sql(" SELECT * FROM hits"),
    "attack_patterns": _sql(" SELECT * FROM hits" + _SORTED_HITS),
    "attack_samples": _sql(
        """
SELECT attack_type, source_ip, substr(request_path, 1, 80) AS sample_path, count(*) AS hits,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen
FROM tagged GROUP BY attack_type, source_ip, substr(request_path, 1, 80)"""
    ),
    "attack_signatures_in_urls": f"""
SELECT {_TYPE_OF.format(path="url")} AS attack_type, count(*) AS row_count FROM pages GROUP BY 1""",
    "attack_signatures_in_texts": f"""
SELECT {_TYPE_OF.format(path="text")} AS attack_type, count(*) AS row_count FROM documents GROUP BY 1""",
    "attack_preview": _sql(" SELECT * FROM hits" + _SORTED_HITS + " LIMIT 30"),
    "attack_top50_per_type": _sql(" SELECT * FROM top_hits"),
    "request_path_preview": _sql(
        " SELECT request_path FROM logs WHERE request_path IS NOT NULL"
        " ORDER BY request_path LIMIT 10"
    ),
    "parsed_timestamps": _sql(
        """ SELECT "timestamp", ts, strftime(ts, '%Y-%m-%d-%H') AS hour_bucket
FROM timed WHERE ts IS NOT NULL"""
    ),
    "port_scans": _sql(" SELECT * FROM scans" + _SORTED_SCANS),
    "port_scans_preview": _sql(" SELECT * FROM scans" + _SORTED_SCANS + " LIMIT 20"),
    "port_scan_threshold_probe": _sql(
        " SELECT max(distinct_targets) AS max_in_any_window FROM windows"
    ),
    "port_scan_summary": _sql(" SELECT * FROM summary" + _SORTED_SUMMARY),
    "port_scan_summary_preview": _sql(" SELECT * FROM summary" + _SORTED_SUMMARY + " LIMIT 10"),
    "protocol_distribution": _sql(
        " SELECT protocol, count(*) AS event_count FROM timed WHERE ts IS NOT NULL"
        " GROUP BY protocol"
    ),
    "threat_timeline": _sql(" SELECT * FROM timeline ORDER BY hour_bucket"),
    "serving_ip_reputation": _sql(" " + _IP_CELLS),
    "serving_attack_patterns": _sql(" " + _ATTACK_CELLS),
    "serving_threat_timeline": _sql(" " + _HOUR_CELLS),
    "serving_upsert": _UPSERT,
    "serving_peek": _sql(
        " SELECT row_key, count(*) AS cell_count FROM cells GROUP BY row_key"
        " ORDER BY row_key LIMIT 3",
        cells=_HOUR_CELLS,
    ),
    "serving_unkeyed": _sql(
        """
SELECT 'ip_reputation' AS table_name,
       count(*) FILTER (WHERE source_ip IS NULL) AS "rows" FROM top_ips
UNION ALL SELECT 'attack_patterns',
       count(*) FILTER (WHERE attack_type IS NULL OR source_ip IS NULL) FROM top_hits
UNION ALL SELECT 'threat_timeline', count(*) FILTER (WHERE hour_bucket IS NULL) FROM timeline"""
    ),
    "ingest_date_partitions": _sql(
        ' SELECT "year", "month", "day", count(*) AS row_count FROM raw_days'
        ' WHERE has_date GROUP BY "year", "month", "day"'
    ),
    "ingest_rejects": _sql(
        ' SELECT "timestamp", count(*) AS row_count FROM raw_days'
        ' WHERE NOT has_date GROUP BY "timestamp"'
    ),
    "ingest_summary": _sql(
        """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE has_date) AS loaded_rows,
       count(*) FILTER (WHERE NOT has_date) AS rejected_rows,
       count(DISTINCT concat("year", '-', "month", '-', "day"))
         FILTER (WHERE has_date) AS day_count
FROM raw_days"""
    ),
    "ingest_roundtrip": _sql(
        f' SELECT {_LOG_COLUMNS}, "year", "month", "day" FROM raw_days WHERE has_date'
    ),
    "ingest_mixed_files": _sql(
        """ SELECT * REPLACE (CASE WHEN coalesce(source_ip LIKE '10.0%', false) THEN user_agent
                           ELSE concat(user_agent, chr(10), 'second line') END AS user_agent)
FROM (SELECT """
        + f'{_LOG_COLUMNS}, "year", "month", "day" FROM raw_days WHERE has_date)'
    ),
    "ingest_rejects_per_run": f"""
WITH runs AS (
  SELECT 'all' AS ingest_id, * FROM ({_VIEW.format(clock="ts")})
  UNION ALL SELECT 'odd', * FROM ({_VIEW.format(clock="ts")} WHERE event_id % 4 = 1))
SELECT ingest_id, "timestamp", count(*) AS row_count FROM runs
WHERE NOT coalesce(regexp_matches("timestamp", '{_DATE}'), false) GROUP BY "timestamp", ingest_id""",
    "ingest_manifest": f"""
WITH lines AS (
  SELECT 1 AS run, * FROM ({_VIEW.format(clock="ts")})
  UNION ALL SELECT 2, * FROM ({_VIEW.format(clock="ts")} WHERE event_id % 2 = 0 AND day(ts) <= 10)),
counts AS (
  SELECT regexp_extract("timestamp", '{_DATE}', 1) AS "year", regexp_extract("timestamp", '{_DATE}', 2) AS "month",
         regexp_extract("timestamp", '{_DATE}', 3) AS "day", run, count(*) AS row_count
  FROM lines WHERE regexp_matches("timestamp", '{_DATE}') GROUP BY ALL)
SELECT "year", "month", "day", arg_max(row_count, run) AS row_count FROM counts GROUP BY ALL""",
    "result_roundtrip": _sql(" SELECT * FROM scans"),
    "result_saved_rows": _sql(" SELECT count(*) AS saved_rows FROM scans"),
    "quality_profile": _sql(" SELECT * FROM profile"),
    "quality_findings": _sql(
        " "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS \"check\", {name} AS row_count, {name} > 0 AS passed, "
            f"CASE WHEN {name} = 0 THEN {_quoted(advice)} END AS advice FROM profile"
            for name, advice in _ADVICE.items()
        )
    ),
}
