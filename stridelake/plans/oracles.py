"""DuckDB SQL equal in meaning to each catalogue query (the correctness
oracle). Written independently of the Spark plans: plain per-trial windows,
correlated minima and recursive CTEs, on the same parquet views.
"""

from __future__ import annotations

# Mapping E as a CTE: trial = user, ms = floor(epoch us / 1000).
FRAMES_E = """
frames AS (
  SELECT user_id AS trial_id, epoch_us(ts) // 1000 AS ms, event_id,
         event_type IN ('view', 'click', 'signup') AS seated, value > 28.0 AS past, value
  FROM events
)"""

# smoothed states, 24 h centred window, majority strictly above one half
SMOOTH_E = FRAMES_E + """,
sm AS (
  SELECT trial_id, ms, event_id,
         avg(seated::INT) OVER w > 0.5 AS s_seated,
         avg(past::INT) OVER w > 0.5 AS s_past
  FROM frames
  WINDOW w AS (PARTITION BY trial_id ORDER BY ms
               RANGE BETWEEN 43199999 PRECEDING AND 43200000 FOLLOWING)
)"""

EVENTS_E = SMOOTH_E + """,
lg AS (
  SELECT *, lag(s_seated) OVER (PARTITION BY trial_id ORDER BY ms, event_id) AS p
  FROM sm
),
a AS (
  SELECT trial_id, min(ms) AS t0,
         count(*) FILTER (WHERE p AND NOT s_seated) AS attempts,
         max(ms) FILTER (WHERE NOT s_seated AND (p IS NULL OR p)) AS t1x
  FROM lg GROUP BY trial_id
),
c1 AS (SELECT trial_id, t0, attempts, CASE WHEN attempts > 0 THEN t1x END AS t1 FROM a),
c2 AS (SELECT c1.*, (SELECT min(ms) FROM sm WHERE sm.trial_id = c1.trial_id
                     AND sm.ms >= c1.t1 AND sm.s_past) AS t2 FROM c1),
c3 AS (SELECT c2.*, (SELECT min(ms) FROM sm WHERE sm.trial_id = c2.trial_id
                     AND sm.ms > c2.t2 AND NOT sm.s_past) AS t3 FROM c2),
c4 AS (SELECT c3.*, (SELECT min(ms) FROM sm WHERE sm.trial_id = c3.trial_id
                     AND sm.ms > c3.t3 AND sm.s_seated) AS t4 FROM c3),
ev AS (
  SELECT trial_id,
         t4 IS NOT NULL AS finished,
         CASE WHEN t4 IS NOT NULL THEN (t4 - t0) / 1000.0::DOUBLE >= 2419200.0 END AS frail,
         CAST(attempts AS INTEGER) AS attempts,
         CASE WHEN t4 IS NOT NULL THEN (t4 - t0) / 1000.0::DOUBLE END AS duration_s,
         (t1 - t0) / 1000.0::DOUBLE AS stand_up_s,
         CASE WHEN t4 IS NOT NULL THEN (t2 - t0) / 1000.0::DOUBLE - (t1 - t0) / 1000.0::DOUBLE END AS to_mark_s,
         CASE WHEN t4 IS NOT NULL THEN (t3 - t0) / 1000.0::DOUBLE - (t2 - t0) / 1000.0::DOUBLE END AS turn_back_s,
         CASE WHEN t4 IS NOT NULL THEN (t4 - t0) / 1000.0::DOUBLE - (t3 - t0) / 1000.0::DOUBLE END AS back_to_chair_s,
         t0 AS t0_ms, t1 AS t1_ms, t4 AS t4_ms
  FROM c4
)"""


def _r(cols):
    return ", ".join(f"round({c}::DOUBLE, 6) AS {c}" for c in cols)


SQL: dict[str, str] = {}

SQL["trial_events"] = "WITH " + EVENTS_E + """
SELECT trial_id, finished, frail, attempts, """ + _r(
    ["duration_s", "stand_up_s", "to_mark_s", "turn_back_s", "back_to_chair_s"]) + """,
       t0_ms, t1_ms, t4_ms
FROM ev"""

SQL["smooth_state"] = "WITH " + SMOOTH_E + """
SELECT trial_id, ms AS frame_ts_ms, event_id, s_seated, s_past FROM sm"""

SQL["smooth_dense"] = "WITH " + FRAMES_E + """
SELECT ms AS frame_ts_ms, event_id, avg(seated::INT) OVER w > 0.5 AS s_seated,
       avg(past::INT) OVER w > 0.5 AS s_past
FROM frames
WINDOW w AS (ORDER BY ms RANGE BETWEEN 388799999 PRECEDING AND 388800000 FOLLOWING)"""

RUNS_E = SMOOTH_E + """,
ch AS (
  SELECT *, CASE WHEN lag(s_seated) OVER w IS DISTINCT FROM s_seated THEN 1 ELSE 0 END AS c
  FROM sm WINDOW w AS (PARTITION BY trial_id ORDER BY ms, event_id)
),
rn AS (
  SELECT *, sum(c) OVER (PARTITION BY trial_id ORDER BY ms, event_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_no
  FROM ch
)"""

SQL["state_runs"] = "WITH " + RUNS_E + """
SELECT trial_id, CAST(run_no AS BIGINT) AS run_no, bool_or(s_seated) AS value,
       min(ms) AS t_start, max(ms) AS t_end, count(*) AS n_rows
FROM rn GROUP BY trial_id, run_no"""

SQL["stand_attempts"] = "WITH " + SMOOTH_E + """,
lg AS (SELECT *, lag(s_seated) OVER (PARTITION BY trial_id ORDER BY ms, event_id) AS p FROM sm)
SELECT trial_id, count(*) FILTER (WHERE p AND NOT s_seated) AS attempts
FROM lg GROUP BY trial_id"""

SAMPLES_E = """
smp AS (SELECT user_id AS trial_id, epoch_us(ts) // 1000 AS ms, event_id, value FROM events)"""

PEAKS_E = SAMPLES_E + """,
nb AS (
  SELECT *, lag(value) OVER w AS pv, lead(value) OVER w AS nv
  FROM smp WINDOW w AS (PARTITION BY trial_id ORDER BY ms, event_id)
),
lp AS (
  SELECT trial_id, ms, event_id, value FROM nb
  WHERE pv IS NOT NULL AND nv IS NOT NULL AND value > pv AND value > nv AND value > 28.0
)"""

SQL["local_peaks"] = "WITH " + PEAKS_E + """
SELECT trial_id, ms AS ts_ms, event_id, value FROM lp"""


def greedy(src: str, gap: str) -> str:
    """CTEs: greedy spacing over rows of ``src`` (trial_id, ms, event_id):
    first row, then repeatedly the first row at or after last + gap."""
    return f"""
gi AS (SELECT trial_id, ms, event_id,
              row_number() OVER (PARTITION BY trial_id ORDER BY ms, event_id) AS rn FROM {src}),
gn AS (
  SELECT a.trial_id, a.rn, min(b.rn) AS nxt
  FROM gi a LEFT JOIN gi b ON b.trial_id = a.trial_id AND b.ms >= a.ms + {gap}
  GROUP BY a.trial_id, a.rn
),
gr AS (
  WITH RECURSIVE walk(trial_id, rn) AS (
    SELECT trial_id, rn FROM gi WHERE rn = 1
    UNION ALL
    SELECT gn.trial_id, gn.nxt FROM walk JOIN gn ON gn.trial_id = walk.trial_id AND gn.rn = walk.rn
    WHERE gn.nxt IS NOT NULL
  )
  SELECT gi.trial_id, gi.ms, gi.event_id FROM walk JOIN gi USING (trial_id, rn)
)"""


SQL["spaced_peaks"] = "WITH " + PEAKS_E + "," + greedy("lp", "86400000") + """
SELECT trial_id, ms AS ts_ms, event_id FROM gr"""

SQL["throttle_events"] = "WITH " + SAMPLES_E + "," + greedy("smp", "86400000") + """
SELECT trial_id, ms AS ts_ms, event_id FROM gr"""

SQL["interval_cv"] = "WITH " + PEAKS_E + "," + greedy("lp", "86400000") + """,
iv AS (SELECT trial_id, (ms - lag(ms) OVER (PARTITION BY trial_id ORDER BY ms, event_id))
                         / 1000.0::DOUBLE AS iv FROM gr)
SELECT trial_id, count(*) AS n_peaks,
       round(CASE WHEN count(iv) >= 2 THEN stddev_pop(iv) / avg(iv) END, 6) AS interval_cv
FROM iv GROUP BY trial_id"""

# -- mapping L ----------------------------------------------------------------
IMU_L = """
imu AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS trial_id,
         CAST(epoch_us(l_shipdate) // 1000 AS DOUBLE) AS host_timestamp_ms,
         l_orderkey AS imu_timestamp_ms,
         l_quantity / 5.0 AS accel_x_g, l_discount * 10.0 AS accel_y_g,
         nullif(l_tax, 0.08) * 10.0 AS accel_z_g,
         l_discount * 25000.0 AS gyro_x_dps, l_tax * 1000.0 AS gyro_y_dps,
         l_quantity AS gyro_z_dps, l_linenumber, l_partkey
  FROM lineitem
)"""

TAGGED_L = IMU_L + """,
dq AS (
  SELECT *, row_number() OVER (
      PARTITION BY trial_id, host_timestamp_ms
      ORDER BY imu_timestamp_ms NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
               accel_x_g NULLS FIRST, accel_y_g NULLS FIRST, accel_z_g NULLS FIRST,
               gyro_x_dps NULLS FIRST, gyro_y_dps NULLS FIRST, gyro_z_dps NULLS FIRST) > 1 AS dup
  FROM imu
),
tg AS (
  SELECT *, concat_ws(',',
      CASE WHEN accel_x_g IS NULL OR accel_y_g IS NULL OR accel_z_g IS NULL OR gyro_x_dps IS NULL
                OR gyro_y_dps IS NULL OR gyro_z_dps IS NULL THEN 'null_value' END,
      CASE WHEN abs(accel_x_g) > 8.0 OR abs(accel_y_g) > 8.0 OR abs(accel_z_g) > 8.0
           THEN 'accel_out_of_range' END,
      CASE WHEN abs(gyro_x_dps) > 2000.0 OR abs(gyro_y_dps) > 2000.0 OR abs(gyro_z_dps) > 2000.0
           THEN 'gyro_out_of_range' END,
      CASE WHEN dup THEN 'duplicate_timestamp' END) AS reasons
  FROM dq
)"""

L_KEYS = "trial_id, host_timestamp_ms, imu_timestamp_ms, l_linenumber, l_partkey"

SQL["quality_tags"] = "WITH " + TAGGED_L + f"""
SELECT {L_KEYS}, reasons, reasons = '' AS quality_ok FROM tg"""

SQL["quality_clean"] = "WITH " + TAGGED_L + f"""
SELECT trial_id, host_timestamp_ms, imu_timestamp_ms, """ + _r(
    ["accel_x_g", "accel_y_g", "accel_z_g", "gyro_x_dps", "gyro_y_dps", "gyro_z_dps"]) + """,
       l_linenumber, l_partkey
FROM tg WHERE reasons = ''"""

SQL["reject_report"] = "WITH " + TAGGED_L + """
SELECT reason, count(*) AS n_rows
FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM tg WHERE reasons <> '')
GROUP BY reason"""

SQL["quality_counts"] = "WITH " + TAGGED_L + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE reasons <> '') AS n_rejected,
       count(*) FILTER (WHERE reasons = '') AS n_kept
FROM tg"""

SQL["dedup_flags"] = "WITH " + TAGGED_L + f"""
SELECT {L_KEYS}, dup AS is_duplicate FROM dq"""

MAGS_L = IMU_L + """,
mg AS (
  SELECT trial_id, host_timestamp_ms, imu_timestamp_ms, l_linenumber, l_partkey,
         sqrt(accel_x_g * accel_x_g + accel_y_g * accel_y_g + accel_z_g * accel_z_g) AS accel_mag,
         sqrt(gyro_x_dps * gyro_x_dps + gyro_y_dps * gyro_y_dps + gyro_z_dps * gyro_z_dps)
           AS gyro_mag
  FROM imu
)"""

SQL["vector_magnitude"] = "WITH " + MAGS_L + f"""
SELECT trial_id, host_timestamp_ms, imu_timestamp_ms,
       l_linenumber, l_partkey, """ + _r(["accel_mag", "gyro_mag"]) + " FROM mg"

SQL["window_peak"] = "WITH " + MAGS_L + """,
t0 AS (SELECT trial_id, min(host_timestamp_ms) AS t0 FROM mg GROUP BY trial_id)
SELECT trial_id, round(max(gyro_mag) FILTER (WHERE host_timestamp_ms >= t0
                                              AND host_timestamp_ms <= t0 + 31536000000.0), 6)
       AS peak_gyro
FROM mg JOIN t0 USING (trial_id) GROUP BY trial_id"""


# -- mapping V: pose ------------------------------------------------------------
def _lm(j: int) -> str:
    return (f"embedding[{3 * j + 1}]::DOUBLE AS x{j}, embedding[{3 * j + 2}]::DOUBLE AS y{j}, "
            f"(abs(embedding[{3 * j + 3}]::DOUBLE) * 10.0)::FLOAT::DOUBLE AS v{j}")


def _angle(h: int, k: int, a: int) -> str:
    v1x, v1y = f"(x{h} - x{k})", f"(y{h} - y{k})"
    v2x, v2y = f"(x{a} - x{k})", f"(y{a} - y{k})"
    dot = f"({v1x} * {v2x} + {v1y} * {v2y})"
    mags = f"(sqrt({v1x} * {v1x} + {v1y} * {v1y}) * sqrt({v2x} * {v2x} + {v2y} * {v2y}))"
    ratio = f"(CASE WHEN {mags} = 0 THEN NULL ELSE {dot} / {mags} END)"
    cosv = f"greatest(-1.0, least(1.0, {ratio}))"
    return (f"CASE WHEN v{h} > 0.5 AND v{k} > 0.5 AND v{a} > 0.5 "
            f"THEN degrees(acos({cosv})) END")


EMBEDDING_FRAMES = """
frames AS (
  SELECT label, vec_id * 4 + f AS vec_id,
         list_transform(range(18), lambda k: embedding[(18 * f + k) % 64 + 1]) AS embedding
  FROM embeddings, range(4) AS r(f)
)"""

POSE_V = EMBEDDING_FRAMES + f""",
lmk AS (
  SELECT CAST(label AS VARCHAR) AS trial_id, vec_id AS frame_ts_ms,
         {", ".join(_lm(j) for j in range(6))}
  FROM frames
),
ang AS (
  SELECT *, {_angle(0, 2, 4)} AS angle_left, {_angle(1, 3, 5)} AS angle_right FROM lmk
),
pf AS (
  SELECT *,
    CASE WHEN angle_left IS NOT NULL AND angle_right IS NOT NULL
           THEN (0.0 + angle_left + angle_right) / 2
         WHEN angle_left IS NOT NULL THEN angle_left ELSE angle_right END AS knee_angle,
    CASE WHEN v4 > 0.5 AND v5 > 0.5 THEN (CASE WHEN x4 >= x5 THEN x4 ELSE x5 END)
         WHEN v4 > 0.5 THEN x4 WHEN v5 > 0.5 THEN x5 END AS fx,
    CASE WHEN v4 > 0.5 AND v5 > 0.5 THEN (CASE WHEN x4 >= x5 THEN y4 ELSE y5 END)
         WHEN v4 > 0.5 THEN y4 WHEN v5 > 0.5 THEN y5 END AS fy
  FROM ang
)"""

SQL["pose_angles"] = "WITH " + POSE_V + """
SELECT trial_id, frame_ts_ms, round(angle_left, 4) AS angle_left,
       round(angle_right, 4) AS angle_right, round(knee_angle, 4) AS knee_angle FROM pf"""

SQL["pose_flags"] = "WITH " + POSE_V + """
SELECT trial_id, frame_ts_ms, knee_angle < 120.0 AS seated,
       round((fx - 0.05) * 1.0 + (fy - (-0.03)) * (-2.10), 4) AS advance,
       (fx - 0.05) * 1.0 + (fy - (-0.03)) * (-2.10) > 0 AS past
FROM pf"""

# -- fusion ---------------------------------------------------------------------
METRICS_E = EVENTS_E + "," + SAMPLES_E + """,
j AS (SELECT smp.*, ev.t0_ms, ev.t1_ms, ev.t4_ms FROM smp JOIN ev USING (trial_id)),
pk AS (SELECT trial_id, max(value) FILTER (WHERE ms >= t0_ms AND ms <= t1_ms) AS peak_standing_dps
       FROM j GROUP BY trial_id),
stw AS (SELECT * FROM j WHERE t1_ms IS NOT NULL AND ms >= t1_ms AND (t4_ms IS NULL OR ms <= t4_ms)),
snb AS (SELECT *, lag(value) OVER w AS pv, lead(value) OVER w AS nv
        FROM stw WINDOW w AS (PARTITION BY trial_id ORDER BY ms, event_id)),
cand AS (SELECT trial_id, ms, event_id FROM snb
         WHERE pv IS NOT NULL AND nv IS NOT NULL AND value > pv AND value > nv AND value > 28.0),
""" + greedy("cand", "86400000") + """,
siv AS (SELECT trial_id, (ms - lag(ms) OVER (PARTITION BY trial_id ORDER BY ms, event_id))
                          / 1000.0::DOUBLE AS iv FROM gr),
sst AS (SELECT trial_id, count(*) AS n_steps,
               CASE WHEN count(iv) >= 2 THEN stddev_pop(iv) / avg(iv) END AS step_cv
        FROM siv GROUP BY trial_id),
mm AS (SELECT pk.trial_id, peak_standing_dps, CAST(coalesce(n_steps, 0) AS INTEGER) AS n_steps,
              step_cv FROM pk LEFT JOIN sst USING (trial_id))"""

SQL["motion_metrics"] = "WITH " + METRICS_E + """
SELECT trial_id, round(peak_standing_dps, 6) AS peak_standing_dps, n_steps,
       round(step_cv, 6) AS step_cv FROM mm"""

RESULTS_E = METRICS_E + """,
res AS (SELECT ev.trial_id, finished, frail, attempts, duration_s, stand_up_s, to_mark_s,
               turn_back_s, back_to_chair_s, t0_ms, peak_standing_dps, n_steps, step_cv
        FROM ev LEFT JOIN mm USING (trial_id))"""

SQL["trial_results"] = "WITH " + RESULTS_E + """
SELECT trial_id, finished, frail, attempts, """ + _r(
    ["duration_s", "stand_up_s", "to_mark_s", "turn_back_s", "back_to_chair_s",
     "peak_standing_dps"]) + ", n_steps, round(step_cv, 6) AS step_cv FROM res"

# -- keys and pending work --------------------------------------------------------
DONE = """
done AS (SELECT o_custkey AS trial_id FROM orders WHERE o_orderstatus = 'F')"""

SQL["new_trials"] = "WITH " + DONE + """
SELECT c_custkey AS trial_id, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.trial_id = c.c_custkey)"""

SQL["pending_trials"] = "WITH " + DONE + """,
src AS (SELECT c_custkey AS trial_id, TRUE AS p FROM customer
        UNION ALL SELECT user_id + 1400, FALSE FROM events),
u AS (SELECT trial_id, bool_or(p) AS p FROM src GROUP BY trial_id)
SELECT trial_id, CASE WHEN p THEN 'not_processed' ELSE 'no_camera' END AS reason
FROM u WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.trial_id = u.trial_id)"""

# -- strings ------------------------------------------------------------------------
SQL["path_metadata"] = r"""
SELECT page_id,
       regexp_extract(url, '/([a-z]+)/([0-9]+)', 1) AS lang,
       TRY_CAST(regexp_extract(url, '/([a-z]+)/([0-9]+)', 2) AS BIGINT) AS item,
       TRY_CAST(regexp_extract(url, 'page=([0-9]+)', 1) AS INTEGER) AS page,
       regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
       string_split(rtrim(url, '/'), '/')[-1] AS last_part,
       lpad(CAST(page_id AS VARCHAR), 16, '0') AS padded_id
FROM pages"""

LINES_L = """
ln AS (
  SELECT concat_ws(',', CAST(l_orderkey AS VARCHAR), CAST(l_quantity AS VARCHAR),
                   CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR),
                   CAST(l_extendedprice AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CASE WHEN l_linestatus = 'O' THEN l_returnflag
                        ELSE CAST(l_suppkey AS VARCHAR) END)
         || CASE WHEN l_linenumber = 7 THEN ',0' ELSE '' END AS line
  FROM lineitem
),
pr AS (SELECT string_split(trim(line), ',') AS p FROM ln)"""

SQL["parse_lines"] = "WITH " + LINES_L + """,
ok AS (
  SELECT TRY_CAST(trim(p[1]) AS BIGINT) AS millis, TRY_CAST(trim(p[2]) AS DOUBLE) AS ax,
         TRY_CAST(trim(p[3]) AS DOUBLE) AS ay, TRY_CAST(trim(p[4]) AS DOUBLE) AS az,
         TRY_CAST(trim(p[5]) AS DOUBLE) AS gx, TRY_CAST(trim(p[6]) AS DOUBLE) AS gy,
         TRY_CAST(trim(p[7]) AS DOUBLE) AS gz
  FROM pr WHERE len(p) = 7
)
SELECT millis, """ + _r(["ax", "ay", "az", "gx", "gy", "gz"]) + """ FROM ok
WHERE millis IS NOT NULL AND ax IS NOT NULL AND ay IS NOT NULL AND az IS NOT NULL
  AND gx IS NOT NULL AND gy IS NOT NULL AND gz IS NOT NULL"""

SQL["rejected_lines"] = "WITH " + LINES_L + """
SELECT CASE WHEN len(p) <> 7 THEN 'fields' ELSE 'number' END AS reason, count(*) AS n_lines
FROM pr
WHERE len(p) <> 7 OR TRY_CAST(trim(p[1]) AS BIGINT) IS NULL OR TRY_CAST(trim(p[2]) AS DOUBLE) IS NULL
   OR TRY_CAST(trim(p[3]) AS DOUBLE) IS NULL OR TRY_CAST(trim(p[4]) AS DOUBLE) IS NULL
   OR TRY_CAST(trim(p[5]) AS DOUBLE) IS NULL OR TRY_CAST(trim(p[6]) AS DOUBLE) IS NULL
   OR TRY_CAST(trim(p[7]) AS DOUBLE) IS NULL
GROUP BY 1"""

# -- reports ----------------------------------------------------------------------
SQL["ranked_results"] = "WITH " + RESULTS_E + """
SELECT trial_id, round(duration_s, 6) AS duration_s,
       row_number() OVER (ORDER BY duration_s DESC NULLS LAST, trial_id) AS rank
FROM res"""

SQL["result_labels"] = "WITH " + RESULTS_E + """
SELECT trial_id,
       left(CAST(trial_id AS VARCHAR), 8) || ' — ' ||
         CASE WHEN finished THEN printf('%.1f', round(duration_s, 1)) || 's'
              ELSE 'unfinished' END ||
         CASE WHEN frail THEN ' ⚠' ELSE '' END AS label,
       CASE WHEN duration_s IS NOT NULL THEN printf('%.1f', round(duration_s, 1)) || 's'
            ELSE '—' END AS duration_txt,
       CASE WHEN frail IS NULL THEN '—' WHEN frail THEN 'yes' ELSE 'no' END AS frail_txt,
       coalesce(printf('%d', attempts), '—') AS attempts_txt,
       coalesce(printf('%d', n_steps), '—') AS steps_txt,
       CASE WHEN peak_standing_dps IS NOT NULL
            THEN printf('%.0f', round(peak_standing_dps, 0)) || '°/s' ELSE '—' END AS peak_txt
FROM res"""

MARKS_E = EVENTS_E + """,
mk AS (
  SELECT trial_id, t0_ms, 1 AS phase_no, 'end of standing up' AS phase, stand_up_s AS t_mark_s
  FROM ev
  UNION ALL SELECT trial_id, t0_ms, 2, 'mark (out)', stand_up_s + to_mark_s FROM ev
  UNION ALL SELECT trial_id, t0_ms, 3, 'mark (back)', stand_up_s + to_mark_s + turn_back_s FROM ev
  UNION ALL SELECT trial_id, t0_ms, 4, 'end of test',
                   stand_up_s + to_mark_s + turn_back_s + back_to_chair_s FROM ev
),
marks AS (SELECT * FROM mk WHERE t_mark_s IS NOT NULL)"""

SQL["phase_marks"] = "WITH " + MARKS_E + """
SELECT trial_id, phase_no, phase, round(t_mark_s, 6) AS t_mark_s FROM marks"""

SQL["phase_shares"] = "WITH " + EVENTS_E + """,
f AS (SELECT *, stand_up_s + to_mark_s + turn_back_s + back_to_chair_s AS total FROM ev
      WHERE stand_up_s IS NOT NULL AND to_mark_s IS NOT NULL AND turn_back_s IS NOT NULL
        AND back_to_chair_s IS NOT NULL),
s AS (
  SELECT trial_id, 1 AS phase_no, 'end of standing up' AS phase, stand_up_s AS seconds,
         stand_up_s / total AS share FROM f
  UNION ALL SELECT trial_id, 2, 'mark (out)', to_mark_s, to_mark_s / total FROM f
  UNION ALL SELECT trial_id, 3, 'mark (back)', turn_back_s, turn_back_s / total FROM f
  UNION ALL SELECT trial_id, 4, 'end of test', back_to_chair_s, back_to_chair_s / total FROM f
)
SELECT trial_id, phase_no, phase, round(seconds, 6) AS seconds, round(share, 6) AS share FROM s"""

SQL["interpolate_marks"] = "WITH " + MARKS_E + "," + SAMPLES_E + """,
am AS (SELECT trial_id, phase_no, t0_ms + t_mark_s * 1000.0 AS at_ms FROM marks),
j2 AS (SELECT am.*, smp.ms, smp.value FROM am JOIN smp USING (trial_id)),
g AS (
  SELECT trial_id, phase_no, at_ms,
         max(ms) FILTER (WHERE ms <= at_ms) AS lo_t, arg_max(value, ms) FILTER (WHERE ms <= at_ms) AS lo_v,
         min(ms) FILTER (WHERE ms >= at_ms) AS hi_t, arg_min(value, ms) FILTER (WHERE ms >= at_ms) AS hi_v,
         arg_min(value, ms) AS first_v, arg_max(value, ms) AS last_v
  FROM j2 GROUP BY trial_id, phase_no, at_ms
)
SELECT trial_id, phase_no,
       round(CASE WHEN lo_t IS NULL THEN first_v WHEN hi_t IS NULL THEN last_v
                  WHEN hi_t = lo_t THEN lo_v
                  ELSE lo_v + ((at_ms - lo_t) / (hi_t - lo_t)) * (hi_v - lo_v) END, 6) AS value_at
FROM g"""

SQL["state_fill"] = "WITH " + FRAMES_E + """,
nf AS (SELECT f.trial_id, f.ms, f.event_id,
              CASE WHEN e.event_type <> 'error' THEN f.seated END AS seated,
              CASE WHEN e.event_type <> 'error' THEN f.past END AS past
       FROM frames f JOIN events e USING (event_id))
SELECT trial_id, ms AS frame_ts_ms, event_id,
  coalesce(last_value(seated IGNORE NULLS) OVER wu, first_value(seated IGNORE NULLS) OVER wf) AS seated,
  coalesce(last_value(past IGNORE NULLS) OVER wu, first_value(past IGNORE NULLS) OVER wf) AS past
FROM nf
WINDOW wu AS (PARTITION BY trial_id ORDER BY ms, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       wf AS (PARTITION BY trial_id ORDER BY ms, event_id
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""

SQL["session_samples"] = """
WITH e AS (SELECT user_id AS trial_id, epoch_us(ts) // 1000 AS ms, event_id, event_type FROM events),
s AS (SELECT trial_id, event_id AS session_id, ms AS start_ms, ms + 21600000 AS end_ms
      FROM e WHERE event_type = 'signup'),
x AS (SELECT trial_id, event_id AS sample_id, ms FROM e WHERE event_type <> 'signup'),
last AS (
  SELECT x.trial_id, x.sample_id, x.ms, s.session_id, s.end_ms,
         row_number() OVER (PARTITION BY x.sample_id
                            ORDER BY s.start_ms DESC, s.session_id DESC) AS rn
  FROM x JOIN s ON x.trial_id = s.trial_id AND x.ms >= s.start_ms)
SELECT trial_id, session_id, sample_id FROM last WHERE rn = 1 AND ms < end_ms"""

SQL["chunk_index"] = "WITH " + IMU_L + f"""
SELECT {L_KEYS},
  CAST((row_number() OVER (PARTITION BY trial_id ORDER BY host_timestamp_ms,
        imu_timestamp_ms NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
        accel_x_g NULLS FIRST, accel_y_g NULLS FIRST, accel_z_g NULLS FIRST,
        gyro_x_dps NULLS FIRST, gyro_y_dps NULLS FIRST, gyro_z_dps NULLS FIRST) - 1) // 500
       AS BIGINT) AS chunk_no
FROM imu"""

SQL["rate_per_hour"] = """
WITH e AS (SELECT user_id AS trial_id, epoch_us(ts) // 1000 AS ms FROM events),
h AS (SELECT trial_id, ms - (ms % 3600000) AS hour_ms, count(*) AS n_events
      FROM e GROUP BY trial_id, hour_ms)
SELECT trial_id, hour_ms, n_events,
       CAST(sum(n_events) OVER (PARTITION BY trial_id ORDER BY hour_ms
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total
FROM h"""

SQL["trial_counts"] = """
WITH f AS (SELECT CAST(user_id AS VARCHAR) AS trial_id, count(*) AS n_frames
           FROM events GROUP BY 1),
s AS (SELECT CAST(l_suppkey AS VARCHAR) AS trial_id, count(*) AS n_samples
      FROM lineitem GROUP BY 1)
SELECT coalesce(f.trial_id, s.trial_id) AS trial_id, coalesce(n_frames, 0) AS n_frames,
       coalesce(n_samples, 0) AS n_samples
FROM f FULL OUTER JOIN s ON f.trial_id = s.trial_id"""

SQL["detect_landmarks"] = """
""" + "WITH " + EMBEDDING_FRAMES + """,
j AS (SELECT unnest(range(6)) AS j, label, vec_id, embedding FROM frames)
SELECT CAST(label AS VARCHAR) AS trial_id, vec_id AS frame_ts_ms, CAST(23 + j AS BIGINT) AS landmark_id,
       round(embedding[3 * j + 1]::DOUBLE, 6) AS x, round(embedding[3 * j + 2]::DOUBLE, 6) AS y,
       round((abs(embedding[3 * j + 3]::DOUBLE) * 10.0)::FLOAT::DOUBLE, 6) AS visibility
FROM j"""

SQL["stream_ingest"] = """
SELECT CAST(user_id AS VARCHAR) AS trial_id, epoch_us(ts) // 1000 AS ms, event_id,
       round(value, 6) AS value
FROM events"""

SQL["stream_rate"] = """
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS trial_id, epoch_us(ts) // 1000 AS ms FROM events),
wm AS (SELECT max(ms) - 3600000 AS wm FROM e),
h AS (SELECT trial_id, ms - (ms % 3600000) AS window_start_ms, count(*) AS n_rows
      FROM e GROUP BY trial_id, window_start_ms)
SELECT trial_id, window_start_ms, n_rows FROM h, wm
WHERE window_start_ms + 3600000 <= wm.wm"""

SQL["layer_silver"] = "WITH " + TAGGED_L + """
SELECT host_timestamp_ms, imu_timestamp_ms, """ + _r(
    ["accel_x_g", "accel_y_g", "accel_z_g", "gyro_x_dps", "gyro_y_dps", "gyro_z_dps"]) + """,
       trial_id
FROM tg WHERE reasons = ''"""

SQL["camera_layers"] = "WITH " + POSE_V + """
SELECT trial_id, frame_ts_ms, knee_angle < 120.0 AS seated,
       (fx - 0.05) * 1.0 + (fy - (-0.03)) * (-2.10) > 0 AS past
FROM pf"""

SQL["source_trials"] = """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS trial_id FROM events"""

SQL["stream_lines"] = SQL["parse_lines"]
SQL["stream_parsed"] = SQL["parse_lines"]
SQL["stream_rejects"] = SQL["rejected_lines"]

SQL["chunk_files"] = "WITH " + IMU_L + """,
n AS (SELECT *, (row_number() OVER (PARTITION BY trial_id ORDER BY host_timestamp_ms NULLS FIRST,
        imu_timestamp_ms NULLS FIRST, accel_x_g NULLS FIRST, accel_y_g NULLS FIRST,
        accel_z_g NULLS FIRST, gyro_x_dps NULLS FIRST, gyro_y_dps NULLS FIRST,
        gyro_z_dps NULLS FIRST) - 1) // 500 AS k
      FROM imu)
SELECT trial_id, 'imu_' || lpad(CAST(CAST(min(host_timestamp_ms) AS BIGINT) AS VARCHAR), 16, '0')
         || '_chunk' || lpad(CAST(k AS VARCHAR), 4, '0') || '.csv' AS file_name,
       count(*) AS n_rows, min(host_timestamp_ms) AS first_ms, max(host_timestamp_ms) AS last_ms,
       CAST(sum(imu_timestamp_ms) AS BIGINT) AS sum_imu_ms, round(sum(gyro_z_dps), 6) AS sum_gyro_z
FROM n GROUP BY trial_id, k"""

SQL["layer_reuse"] = "SELECT c_custkey AS trial_id, c_name, c_nationkey FROM customer"

SQL["fusion_results"] = SQL["trial_results"]

SQL["imu_chain"] = SQL["layer_silver"]
SQL["chain_late_files"] = SQL["layer_silver"]

SQL["camera_chain"] = SQL["camera_layers"]

SQL["sample_seconds"] = """
WITH e AS (SELECT user_id AS trial_id, epoch_us(ts) // 1000 AS ts_ms, event_id FROM events)
SELECT trial_id, ts_ms, event_id,
       round((ts_ms - min(ts_ms) OVER (PARTITION BY trial_id)) / 1000.0::DOUBLE, 6) AS t_s,
       CAST(floor((ts_ms - min(ts_ms) OVER (PARTITION BY trial_id)) / 1000.0::DOUBLE
                  * 1000.0::DOUBLE) AS BIGINT) AS t_ms
FROM e"""

SQL["stream_rate_all"] = """
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS trial_id, epoch_us(ts) // 1000 AS ms FROM events)
SELECT trial_id, ms - (ms % 3600000) AS window_start_ms, count(*) AS n_rows FROM e GROUP BY 1, 2"""

# -- repeated frame times, unknown states, report series ------------------------------
REPEATED_E = """
known AS (
  SELECT user_id AS trial_id, event_id,
         epoch_us(ts) // 1000 - (epoch_us(ts) // 1000) % 21600000 AS ms,
         CASE WHEN event_type <> 'error' THEN event_type IN ('view', 'click', 'signup') END AS seated,
         CASE WHEN event_type <> 'error' THEN value > 28.0 END AS past
  FROM events
),
frames AS (SELECT * FROM known WHERE seated IS NOT NULL AND past IS NOT NULL)"""
REPEATED_EVENTS_E = REPEATED_E + EVENTS_E[len(FRAMES_E):]

SQL["repeated_frame_events"] = "WITH " + REPEATED_EVENTS_E + """
SELECT u.trial_id, coalesce(finished, FALSE) AS finished, frail,
       coalesce(attempts, 0)::INTEGER AS attempts, """ + _r(
    ["duration_s", "stand_up_s", "to_mark_s", "turn_back_s", "back_to_chair_s"]) + """,
       t0_ms, t1_ms, t4_ms
FROM (SELECT DISTINCT trial_id FROM known) u LEFT JOIN ev USING (trial_id)"""

SQL["state_series"] = "WITH " + REPEATED_EVENTS_E + """
SELECT k.trial_id, event_id, ms AS frame_ts_ms,
  coalesce(last_value(seated IGNORE NULLS) OVER wu, first_value(seated IGNORE NULLS) OVER wf) AS seated,
  coalesce(last_value(past IGNORE NULLS) OVER wu, first_value(past IGNORE NULLS) OVER wf) AS past,
  round((ms - t0_ms) / 1000.0::DOUBLE, 6) AS t_s
FROM known k LEFT JOIN ev USING (trial_id)
WINDOW wu AS (PARTITION BY k.trial_id ORDER BY ms, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       wf AS (PARTITION BY k.trial_id ORDER BY ms, event_id
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""

SQL["imu_series"] = "WITH " + EVENTS_E + """,
t0 AS (SELECT trial_id::VARCHAR AS trial_id, t0_ms FROM ev),
li AS (
  SELECT l_suppkey::VARCHAR AS trial_id, CAST(epoch_us(l_shipdate) // 1000 AS DOUBLE) AS host_timestamp_ms,
         l_orderkey AS imu_timestamp_ms, l_linenumber, l_partkey,
         l_quantity / 5.0 AS ax, l_discount * 10.0 AS ay, nullif(l_tax, 0.08) * 10.0 AS az,
         l_discount * 25000.0 AS gx, l_tax * 1000.0 AS gy, l_quantity AS gz
  FROM lineitem)
SELECT trial_id, host_timestamp_ms, imu_timestamp_ms, l_linenumber, l_partkey,
       round((host_timestamp_ms - t0_ms) / 1000.0::DOUBLE, 6) AS t_s,
       round(sqrt(ax * ax + ay * ay + az * az), 6) AS accel_mag,
       round(sqrt(gx * gx + gy * gy + gz * gz), 6) AS gyro_mag
FROM li LEFT JOIN t0 USING (trial_id)"""

SQL["pending_report"] = (SQL["pending_trials"].replace("SELECT trial_id, CASE", "SELECT trial_id, "
                         "row_number() OVER (ORDER BY trial_id) AS place, CASE"))

# -- keyed state over streams ----------------------------------------------------------
SQL["stream_running_total"] = """
WITH e AS (SELECT user_id AS trial_id, epoch_us(ts) // 1000 AS ms FROM events),
h AS (SELECT trial_id, ms - (ms % 3600000) AS window_start_ms, count(*) AS n_rows
      FROM e GROUP BY 1, 2)
SELECT trial_id, window_start_ms, n_rows,
       CAST(sum(n_rows) OVER (PARTITION BY trial_id ORDER BY window_start_ms) AS BIGINT) AS running_total
FROM h WHERE window_start_ms + 3600000 <= (SELECT max(ms) - 3600000 FROM e)"""

SQL["stream_sessions"] = SQL["session_samples"].replace("WHERE rn = 1 AND ms < end_ms", """
WHERE rn = 1 AND ms < end_ms AND ms - ms % 86400000 + 86400000 <=
  (SELECT least(max(ms) FILTER (event_type = 'signup'), max(ms) FILTER (event_type <> 'signup'))
          - 3600000 FROM e)""")

# -- frames with failures ----------------------------------------------------------------
CAMERA_FRAMES = """
frames AS (
  SELECT CAST(label AS VARCHAR) AS trial_id, CASE WHEN vec_id % 17 <> 5 THEN vec_id END AS frame_ts_ms,
         len(embedding) AS n,
         CASE WHEN vec_id % 17 = 5 THEN 'no_time' WHEN vec_id % 13 = 2 THEN 'ValueError'
              WHEN vec_id % 19 = 7 THEN 'no_content' END AS reason
  FROM embeddings)"""

SQL["detect_batches"] = "WITH " + CAMERA_FRAMES + """
SELECT trial_id, frame_ts_ms, reason,
       CAST(CASE WHEN reason IS NULL THEN least(6, n // 3) ELSE 0 END AS BIGINT) AS n_landmarks
FROM frames WHERE frame_ts_ms IS NOT NULL"""

SQL["rejected_frames"] = "WITH " + CAMERA_FRAMES + """
SELECT trial_id, reason, count(*) AS n_frames FROM frames WHERE reason IS NOT NULL GROUP BY 1, 2"""
