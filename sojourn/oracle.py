"""Independent SQL statements of every registered query, for DuckDB.

These are the correctness oracle: the plain, textbook window form of each rule
(one ``PARTITION BY id`` walk, no slicing, no duplicate folding), written
separately from the Spark code.  The views ``events`` and ``documents`` are
the raw test tables; the derived shapes below mirror ``sources/tables.py``.

Integers are cast to BIGINT on both sides (DuckDB sums are HUGEINT).
"""

from __future__ import annotations

# --- derived test shapes (mirror sources/tables.py) -------------------------

T = "CAST(epoch_us(ts) // 1000000 AS BIGINT)"
DEVICE = "concat('device-', lpad(CAST(user_id % 2 AS VARCHAR), 6, '0'))"

VIEWS = {
    "points": f"SELECT {DEVICE} AS id, {T} AS t, event_type AS site FROM events",
    "points_mixed": f"""SELECT {DEVICE} AS id, {T} AS t,
        CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS site FROM events""",
    "points_dirty": f"""SELECT
        CASE WHEN event_id % 11 = 0 THEN 'd1'
             WHEN event_id % 5 = 0 THEN '"' || {DEVICE} || '"'
             ELSE {DEVICE} END AS id,
        CASE WHEN event_id % 97 = 0 THEN {T} * 1000 ELSE {T} END AS t,
        CASE WHEN event_type = 'error' THEN event_type
             WHEN event_id % 7 = 0 THEN '"' || rpad(event_type, 14, '_') || '"'
             ELSE rpad(event_type, 14, '_') END AS site
        FROM events""",
    "intervals": f"""SELECT {DEVICE} AS id, {T} AS stime, event_type AS site,
        {T} + CAST(floor(value) AS BIGINT) AS etime FROM events""",
    "intervals_null": f"""SELECT {DEVICE} AS id, {T} AS stime, event_type AS site,
        CASE WHEN event_id % 3 = 0 THEN NULL ELSE {T} + CAST(floor(value) AS BIGINT) END AS etime FROM events""",
    "intervals_dirty": f"""SELECT id, stime, CASE WHEN event_type = 'error' THEN event_type
             WHEN event_id % 7 = 0 THEN '"' || rpad(event_type, 14, '_') || '"' ELSE rpad(event_type, 14, '_') END AS site,
        etime FROM (SELECT event_id, event_type, {DEVICE} AS id, {T} AS stime,
        CASE WHEN event_id % 3 = 0 THEN NULL ELSE {T} + CAST(floor(value) AS BIGINT) END AS etime FROM events)""",
    "log": f"""SELECT event_id, {T} AS t, CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS user_id,
        event_type, props, strftime(ts, '%Y%m%d') AS day FROM events""",
    "control": """SELECT event_id AS id, 'job' || CAST(user_id AS VARCHAR) AS type, event_type AS name,
        ' ' || CAST(event_id AS VARCHAR) || ' ' AS value FROM events""",
    "lines": """SELECT replace(coalesce(text, ''), chr(10), CASE WHEN doc_id % 2 = 0 THEN chr(13) ELSE ' ' END) AS line
        FROM documents""",
}


def with_views(body: str, *names: str, extra: list[str] | None = None) -> str:
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names] + list(extra or [])
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


# --- rule fragments ---------------------------------------------------------

def seg_points(src: str, out: str, gap: int = 7200) -> list[str]:
    """T1: points (id, t, site) -> out (id, seg, stime, site, etime)."""
    return [
        f"{out}_o AS (SELECT id, t, site, row_number() OVER (PARTITION BY id ORDER BY t, site) AS rn FROM {src}"
        f" WHERE id IS NOT NULL AND t IS NOT NULL AND site IS NOT NULL)",
        f"""{out}_b AS (SELECT *, CASE WHEN lag(t) OVER w IS NULL OR lower(site) <> lower(lag(site) OVER w)
              OR t - lag(t) OVER w >= {gap} THEN 1 ELSE 0 END AS brk
            FROM {out}_o WINDOW w AS (PARTITION BY id ORDER BY rn))""",
        f"{out}_s AS (SELECT *, sum(brk) OVER (PARTITION BY id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS seg FROM {out}_b)",
        f"""{out} AS (SELECT id, CAST(seg AS BIGINT) AS seg, min(t) AS stime, arg_min(site, rn) AS site,
              max(t) AS etime FROM {out}_s GROUP BY id, seg)""",
    ]


def seg_intervals(src: str, out: str, gap: int = 7200) -> list[str]:
    """T2: intervals (id, stime, site, etime) -> out (id, seg, stime, site, etime)."""
    return [
        f"""{out}_o AS (SELECT id, stime, site, etime,
              row_number() OVER (PARTITION BY id ORDER BY stime, site, etime) AS rn FROM {src}
              WHERE id IS NOT NULL AND stime IS NOT NULL AND site IS NOT NULL AND etime IS NOT NULL)""",
        f"""{out}_b AS (SELECT *, CASE WHEN lag(etime) OVER w IS NULL OR lower(site) <> lower(lag(site) OVER w)
              OR stime - lag(etime) OVER w >= {gap} THEN 1 ELSE 0 END AS brk
            FROM {out}_o WINDOW w AS (PARTITION BY id ORDER BY rn))""",
        f"{out}_s AS (SELECT *, sum(brk) OVER (PARTITION BY id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS seg FROM {out}_b)",
        f"""{out} AS (SELECT id, CAST(seg AS BIGINT) AS seg, arg_min(stime, rn) AS stime, arg_min(site, rn) AS site,
              arg_max(etime, rn) AS etime FROM {out}_s GROUP BY id, seg)""",
    ]


def runs(src: str, out: str, dur: int, gap: int) -> list[str]:
    """T3/T4: segments -> + short, run."""
    return [
        f"""{out}_x AS (SELECT *, coalesce(etime - stime < {dur}
              AND stime - lag(etime) OVER (PARTITION BY id ORDER BY seg) < {gap}, false) AS short FROM {src})""",
        f"""{out} AS (SELECT *, CAST(sum(CASE WHEN short THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY seg
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM {out}_x)""",
    ]


def split(src: str, out: str, key: list[str]) -> list[str]:
    """T5: runs -> out (id, *key, stime, site, etime)."""
    k = ", ".join(["id", *key])
    return [
        f"""{out}_a AS (SELECT *, arg_min(stime, seg) OVER (PARTITION BY {k}) AS lo,
              arg_max(etime, seg) OVER (PARTITION BY {k}) AS hi FROM {src})""",
        f"""{out}_g AS (SELECT {k}, site, min(seg) AS fp, any_value(lo) AS lo, any_value(hi) AS hi
              FROM {out}_a GROUP BY {k}, site)""",
        f"""{out}_r AS (SELECT *, count(*) OVER (PARTITION BY {k}) AS k,
              row_number() OVER (PARTITION BY {k} ORDER BY fp) - 1 AS r FROM {out}_g)""",
        f"""{out} AS (SELECT {k}, CAST(lo + r * ((hi - lo) // k) AS BIGINT) AS stime, site,
              CAST(lo + (r + 1) * ((hi - lo) // k) AS BIGINT) AS etime FROM {out}_r)""",
    ]


def relay(src: str, out: str, min_run: int = 3) -> list[str]:
    """T6: runs -> out (id, run, ord, stime, site, etime)."""
    return [
        f"{out}_n AS (SELECT *, count(*) OVER (PARTITION BY id, run) AS n FROM {src})",
        f"""{out}_g AS (SELECT id, run, site, n >= {min_run} AS big, min(stime) AS m,
              sum(etime - stime) AS d, min(seg) AS fp
              FROM {out}_n GROUP BY id, run, site, n >= {min_run}, CASE WHEN n < {min_run} THEN seg END)""",
        f"""{out}_w AS (SELECT *, row_number() OVER (PARTITION BY id, run ORDER BY m, fp) AS pos,
              sum(d) OVER (PARTITION BY id, run ORDER BY m, fp ROWS UNBOUNDED PRECEDING) AS s FROM {out}_g)""",
        f"""{out}_x AS (SELECT *, s + max(m - (s - d)) OVER (PARTITION BY id, run ORDER BY m, fp
              ROWS UNBOUNDED PRECEDING) AS x FROM {out}_w)""",
        f"""{out} AS (SELECT id, run, CAST(CASE WHEN big THEN pos ELSE fp END AS BIGINT) AS ord,
              CAST(CASE WHEN big THEN x - d ELSE m END AS BIGINT) AS stime, site,
              CAST(CASE WHEN big THEN x ELSE m + d END AS BIGINT) AS etime FROM {out}_x)""",
    ]


def remerge(src: str, out: str, order: str, gap: int = 7200) -> list[str]:
    """T7: rows in `order` per id -> out (id, stime, site, etime)."""
    return [
        f"{out}_o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS rn FROM {src})",
        f"""{out}_b AS (SELECT *, CASE WHEN lag(etime) OVER w IS NULL OR lower(site) <> lower(lag(site) OVER w)
              OR etime - lag(etime) OVER w >= {gap} THEN 1 ELSE 0 END AS brk
            FROM {out}_o WINDOW w AS (PARTITION BY id ORDER BY rn))""",
        f"{out}_s AS (SELECT *, sum(brk) OVER (PARTITION BY id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS mseg FROM {out}_b)",
        f"""{out} AS (SELECT id, arg_min(stime, rn) AS stime, arg_min(site, rn) AS site, arg_max(etime, rn) AS etime
              FROM {out}_s GROUP BY id, mseg)""",
    ]


def trace_relay_ctes(src: str = "points") -> list[str]:
    return (seg_points(src, "s1") + runs("s1", "r1", 60, 180) + relay("r1", "v1")
            + remerge("v1", "m1", "run, ord"))


def trace_split_ctes(src: str, dur: int, gap: int, key: list[str], intervals: bool = False) -> list[str]:
    seg = seg_intervals(src, "s1") if intervals else seg_points(src, "s1")
    return seg + runs("s1", "r1", dur, gap) + split("r1", "q1", key)


def _q(body: str, *views: str, extra: list[str] | None = None) -> str:
    return with_views(body, *views, extra=extra)


# --- the registered queries -------------------------------------------------

# Fixed ranges used by the queries (epoch seconds, UTC).
DAY_RANGE = (1704412800, 1704499200)          # 2024-01-05, half-open
MIDNIGHT_RANGE = (1704477600, 1704520800)     # 2024-01-05 18:00 .. 2024-01-06 06:00
DAY_SECONDS = 86400
CLOSED_END = 1704520400                       # an existing event's second at sf0.01
FULL_RANGE = (1704067200, 1706745600)         # 2024-01-01 .. 2024-02-01: the whole table
JOB_START = FULL_RANGE[0]
JOB_END = FULL_RANGE[1]
INCREMENT_ENDS = (1705276800, JOB_END, JOB_END + DAY_SECONDS)   # two slices and an empty one
LOG_COLS = "event_id, t, user_id, event_type, props"
SEG_COLS = "id, stime, site, etime"


def _tsv(cols: list[str]) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in cols]
    return "replace(concat_ws(chr(9), " + ", ".join(parts) + "), '\"', '')"


def _segment_line(source: str) -> str:
    return f"concat_ws(chr(9), id, CAST(stime AS VARCHAR), site, CAST(etime AS VARCHAR), '{source}')"


def _clean_points(src: str, strict_sites: bool) -> str:
    site_rule = " AND length(site) = 14" if strict_sites else ""
    return (f"SELECT replace(id, '\"', '') AS id, t, replace(site, '\"', '') AS site FROM {src}"
            f" WHERE length(replace(id, '\"', '')) > 10 AND t BETWEEN 1000000000 AND 9999999999"
            + site_rule.replace("site", "replace(site, '\"', '')"))


def _core(q: dict[str, str]) -> None:
    a, b = DAY_RANGE
    m0, _ = MIDNIGHT_RANGE

    # scans
    q["log_scan_closed"] = _q(
        f"SELECT {LOG_COLS} FROM log WHERE day IN ('20240105', '20240106') AND t >= {m0} AND t <= {CLOSED_END}",
        "log")
    q["log_scan_half_open"] = _q(
        f"SELECT {LOG_COLS} FROM log WHERE day = '20240105' AND t >= {a} AND t < {b}", "log")
    q["day_pruned_scan"] = _q(
        f"SELECT {LOG_COLS} FROM log WHERE t >= {m0} AND t < {MIDNIGHT_RANGE[1]}", "log")
    q["point_scan"] = _q(
        f"SELECT id, t, site FROM points WHERE t >= {m0} AND t < {MIDNIGHT_RANGE[1]}", "points")
    q["endpoint_events"] = _q(
        "SELECT id, stime AS t, site FROM intervals_null UNION ALL "
        "SELECT id, etime AS t, site FROM intervals_null WHERE etime IS NOT NULL", "intervals_null")

    # cleaning rules and scalars
    q["strip_quotes"] = _q(
        "SELECT replace(id, '\"', '') AS id, t, replace(site, '\"', '') AS site FROM points_dirty", "points_dirty")
    q["valid_epoch"] = _q("SELECT id, t, site FROM points_dirty WHERE t BETWEEN 1000000000 AND 9999999999",
                          "points_dirty")
    q["valid_id"] = _q(
        "SELECT replace(id, '\"', '') AS id, t, site FROM points_dirty WHERE length(replace(id, '\"', '')) > 10",
        "points_dirty")
    q["valid_site"] = _q(
        "SELECT id, t, replace(site, '\"', '') AS site FROM points_dirty WHERE length(replace(site, '\"', '')) = 14",
        "points_dirty")
    q["epoch_to_day"] = (
        f"SELECT event_id, strftime(make_timestamp(({T}) * 1000000), '%Y%m%d') AS day_s, "
        f"strftime(make_timestamp(({T}) * 1000000), '%Y%m%d') AS day_ms FROM events")
    q["csv_index"] = ("SELECT event_id, CAST(coalesce(list_position(string_split('click,view,error', ','), "
                      "event_type), 0) - 1 AS BIGINT) AS idx FROM events")
    q["row_to_tsv"] = _q(f"SELECT t, {_tsv(LOG_COLS.split(', '))} AS line FROM log", "log")

    # ordered per-id operators
    q["dwell_segments"] = _q(f"SELECT {SEG_COLS} FROM s1", "points", extra=seg_points("points", "s1"))
    q["dwell_segments_mixed"] = _q(f"SELECT {SEG_COLS} FROM s1", "points_mixed",
                                   extra=seg_points("points_mixed", "s1"))
    q["interval_segments"] = _q(f"SELECT {SEG_COLS} FROM s1", "intervals", extra=seg_intervals("intervals", "s1"))
    q["runs_head_excluded"] = _q("SELECT id, seg, stime, site, etime, short, run FROM r1", "points",
                                 extra=seg_points("points", "s1") + runs("s1", "r1", 300, 1800))
    q["runs_head_included"] = _q("SELECT id, seg, stime, site, etime, short, run FROM r1", "points",
                                 extra=seg_points("points", "s1") + runs("s1", "r1", 60, 180))
    q["split_equal"] = _q("SELECT id, run, stime, site, etime FROM q1", "points",
                          extra=trace_split_ctes("points", 60, 180, ["run"]))
    q["relay_by_dwell"] = _q("SELECT id, run, ord, stime, site, etime FROM v1", "points",
                             extra=seg_points("points", "s1") + runs("s1", "r1", 60, 180) + relay("r1", "v1"))
    q["remerge"] = _q(f"SELECT {SEG_COLS} FROM m1", "intervals",
                      extra=remerge("intervals", "m1", "stime, site, etime"))
    q["trace_split_excl"] = _q(f"SELECT DISTINCT {SEG_COLS} FROM q1", "points",
                               extra=trace_split_ctes("points", 300, 1800, ["run", "short"]))
    q["trace_split_incl"] = _q(f"SELECT DISTINCT {SEG_COLS} FROM q1", "points",
                               extra=trace_split_ctes("points", 300, 300, ["run"]))
    q["trace_relay"] = _q(f"SELECT {SEG_COLS} FROM m1", "points", extra=trace_relay_ctes("points"))
    q["trace_interval"] = _q(f"SELECT DISTINCT {SEG_COLS} FROM q1", "intervals",
                             extra=trace_split_ctes("intervals", 300, 300, ["run", "short"], intervals=True))


def _more(q: dict[str, str]) -> None:
    s, e = JOB_START, JOB_END
    q["segment_to_tsv"] = _q(f"SELECT stime AS t, {_segment_line('1')} AS line FROM m1", "points",
                             extra=trace_relay_ctes("points"))
    q["events_per_id"] = _q(
        """SELECT id, CAST(sum(n) OVER (PARTITION BY id ORDER BY t, site ROWS UNBOUNDED PRECEDING) - n + 1 AS BIGINT)
             AS pos, t, site, n
           FROM (SELECT id, t, site, CAST(count(*) AS BIGINT) AS n FROM points GROUP BY id, t, site)""", "points")
    q["flatten_events"] = _q(
        "SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY t, site) AS BIGINT) AS pos, t, site FROM points",
        "points")

    # jobs over the whole table
    q["job_trace_points"] = _q(
        f"SELECT stime AS t, {_segment_line('1')} AS line FROM m1", "points_dirty",
        extra=[f"c AS ({_clean_points('points_dirty', False)} AND t >= {s} AND t < {e})"] + trace_relay_ctes("c"))
    q["job_trace_split"] = _q(
        f"SELECT DISTINCT stime AS t, {_segment_line('1')} AS line FROM q1", "points_dirty",
        extra=[f"c AS ({_clean_points('points_dirty', True)} AND t >= {s} AND t < {e})"]
        + trace_split_ctes("c", 300, 1800, ["run", "short"]))
    q["job_trace_endpoints"] = _q(
        f"SELECT stime AS t, {_segment_line('2')} AS line FROM m1", "intervals_null",
        extra=[f"""ep AS (SELECT id, stime AS t, site FROM intervals_null WHERE stime >= {s} AND stime < {e}
                   UNION ALL SELECT id, etime AS t, site FROM intervals_null
                   WHERE stime >= {s} AND stime < {e} AND etime IS NOT NULL)""",
               f"c AS ({_clean_points('ep', False)})"] + trace_relay_ctes("c"))
    q["job_log_export"] = _q(
        f"SELECT t, {_tsv(LOG_COLS.split(', '))} AS line FROM log WHERE t >= {s} AND t < {e} "
        f"AND t BETWEEN 1000000000 AND 9999999999", "log")

    q["job_split_endpoints"] = _q(
        f"SELECT DISTINCT stime AS t, {_segment_line('2')} AS line FROM q1", "intervals_dirty",
        extra=[f"""ep AS (SELECT id, stime AS t, site FROM intervals_dirty WHERE stime >= {s} AND stime < {e}
                   UNION ALL SELECT id, etime AS t, site FROM intervals_dirty
                   WHERE stime >= {s} AND stime < {e} AND etime IS NOT NULL)""",
               f"c AS ({_clean_points('ep', True)})"] + trace_split_ctes("c", 300, 1800, ["run", "short"]))
    q["job_log_export_closed"] = _q(
        f"SELECT t, {_tsv(LOG_COLS.split(', '))} AS line FROM log WHERE t >= {MIDNIGHT_RANGE[0]} AND t <= {CLOSED_END} "
        f"AND t BETWEEN 1000000000 AND 9999999999", "log")
    starts = (s, *INCREMENT_ENDS[:-1])
    q["job_incremental"] = _q(
        f"SELECT 'line' AS kind, CAST(NULL AS VARCHAR) AS name, {_tsv(LOG_COLS.split(', '))} AS value FROM log "
        f"WHERE t >= {s} AND t < {INCREMENT_ENDS[-1]} "
        + " ".join(f"UNION ALL SELECT 'audit', 'export', '{a},{b}' UNION ALL SELECT 'mark', 'stopTime', '{b}' "
                   f"UNION ALL SELECT 'mark', 'resultNums', (SELECT CAST(count(*) AS VARCHAR) FROM log WHERE t >= {a} AND t < {b})"
                   for a, b in zip(starts, INCREMENT_ENDS)), "log")

    # statistics and the mark
    stats = (f"""stats AS (SELECT job, CAST(count(*) AS BIGINT) AS count_in, max(t) AS max_in,
                 CAST(count(*) FILTER (WHERE t BETWEEN 1000000000 AND 9999999999) AS BIGINT) AS count_out,
                 CAST(greatest({s}, max(t) FILTER (WHERE t BETWEEN 1000000000 AND 9999999999)) AS BIGINT) AS max_out
               FROM (SELECT 'job' || CAST(user_id AS VARCHAR) AS job,
                            CASE WHEN event_id % 97 = 0 THEN {T} * 1000 ELSE {T} END AS t FROM events)
               GROUP BY job)""")
    q["write_stats"] = _q("SELECT * FROM stats", extra=[stats])
    q["next_watermark"] = _q(
        f"""SELECT job, CAST(CASE WHEN count_in = count_out OR max_in = max_out THEN {e}
                  ELSE max_out + CASE WHEN max_out < {e} THEN 1 ELSE 0 END END AS BIGINT) AS stop_time,
                  count_out AS result_nums FROM stats""", extra=[stats])

    # control state
    norm = "SELECT id, trim(type) AS type, trim(name) AS name, trim(value) AS value FROM control"
    probes = ("p AS (SELECT type, CASE WHEN id % 3 = 0 THEN name ELSE name || '-old' END AS name FROM n WHERE id % 2 = 1)")
    latest = "SELECT type, name, max(id) AS id, arg_max(value, id) AS value FROM {src} GROUP BY type, name"
    q["state_latest"] = _q(
        "SELECT id, type, name, value FROM (" + latest.format(src="n") + ")", "control",
        extra=[f"n AS ({norm})"])
    q["state_upsert"] = _q(
        """SELECT o.id, o.type, o.name, CASE WHEN u.id IS NOT NULL THEN u.value ELSE o.value END AS value
           FROM o LEFT JOIN u ON o.type = u.type AND o.name = u.name
           UNION ALL SELECT id, type, name, value FROM u
           WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.type = u.type AND o.name = u.name)""", "control",
        extra=[f"n AS ({norm})", "o AS (SELECT * FROM n WHERE id % 2 = 0)",
               "u AS (" + latest.format(src="(SELECT * FROM n WHERE id % 2 = 1)") + ")"])
    q["state_delete"] = _q(
        """SELECT id, type, name, value FROM n WHERE id % 2 = 0 AND NOT EXISTS (
             SELECT 1 FROM p WHERE p.type = n.type AND p.name = n.name)""",
        "control", extra=[f"n AS ({norm})", probes])
    q["state_exists"] = _q(
        """SELECT DISTINCT p.type, p.name, EXISTS (SELECT 1 FROM n b WHERE b.id % 2 = 0
                 AND b.type = p.type AND b.name = p.name) AS "exists" FROM p""", "control", extra=[f"n AS ({norm})", probes])

    # sinks: the published line multiset equals the input lines
    q["publish_lines"] = _q("SELECT line FROM lines", "lines")
    q["compact_lines"] = _q("SELECT line FROM lines", "lines")
    end_text = "2024-02-01 00:00:00"
    q["audit_append"] = _q(f"SELECT '{end_text}' AS ts, 'trace_relay' AS title, CAST(count(*) AS VARCHAR) AS content, "
                           "CAST(NULL AS VARCHAR) AS path, CAST(NULL AS BIGINT) AS bytes, CAST(NULL AS BIGINT) AS duration_ms FROM m1 "
                           f"UNION ALL SELECT '{end_text}', 'import', 'log', 'library/log', "
                           f"CAST(sum(length({_tsv(LOG_COLS.split(', '))}) + 1) AS BIGINT), 0 FROM log",
                           "points", "log", extra=trace_relay_ctes("points"))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    _core(q)
    _more(q)
    return q
