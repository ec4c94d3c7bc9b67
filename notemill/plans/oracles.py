"""SQL equivalents of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

NOTES = """
raw_notes AS (
  SELECT user_id AS song_id, event_id, ts,
         (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 3600000000 AS ms,
         CASE event_type WHEN 'click' THEN '1000' WHEN 'view' THEN '0100'
                         WHEN 'purchase' THEN '0010' ELSE '0001' END AS orientation
  FROM events),
notes AS (
  SELECT song_id, row_number() OVER (PARTITION BY song_id ORDER BY ts, event_id) AS note_id,
         ms * 30 // 1000 AS framers, ms, orientation
  FROM raw_notes)"""

SEPARATED = NOTES + """,
separated AS (
  SELECT song_id, note_id, framers, orientation,
         CASE WHEN ms = lag(ms) OVER (PARTITION BY song_id, orientation ORDER BY ms, note_id)
              THEN ms + 1 ELSE ms END AS ms
  FROM notes)"""

MERGED = SEPARATED + """,
merged AS (
  SELECT song_id, ms, min(note_id) AS note_id, min(framers) AS framers,
         max(substr(orientation, 1, 1)) || max(substr(orientation, 2, 1))
         || max(substr(orientation, 3, 1)) || max(substr(orientation, 4, 1)) AS orientation
  FROM separated GROUP BY song_id, ms)"""

LANES = MERGED + """,
lanes AS (
  SELECT song_id, note_id, ms, l.lane AS orientation
  FROM merged JOIN (VALUES (1, '1000'), (2, '0100'), (3, '0010'), (4, '0001')) l(pos, lane)
    ON substr(merged.orientation, l.pos, 1) = '1')"""

VERTICAL = """
vertical AS (
  SELECT song_id, note_id, ms, orientation, prev_ms, ms - prev_ms AS gap,
         CASE WHEN ms > prev_ms THEN 1000::DOUBLE / (ms - prev_ms) ELSE 0::DOUBLE END AS vertical_density
  FROM (SELECT *, lag(ms) OVER (PARTITION BY song_id, orientation ORDER BY ms, note_id) AS prev_ms FROM lanes))"""

WEIGHT = """CASE WHEN t.ms - n.ms >= -117 AND t.ms - n.ms < -83 THEN 0.1::DOUBLE
            WHEN t.ms - n.ms >= -83 AND t.ms - n.ms < -50 THEN 0.5
            WHEN t.ms - n.ms >= -50 AND t.ms - n.ms < -17 THEN 1.0
            WHEN t.ms - n.ms >= -17 AND t.ms - n.ms < 17 THEN 1.0
            WHEN t.ms - n.ms >= 17 AND t.ms - n.ms < 50 THEN 1.0
            WHEN t.ms - n.ms >= 50 AND t.ms - n.ms < 83 THEN 0.5
            WHEN t.ms - n.ms >= 83 AND t.ms - n.ms < 117 THEN 0.5 ELSE 0.0 END"""

HORIZONTAL = f"""
horizontal AS (
  SELECT t.song_id, t.note_id, t.ms, t.orientation, round(sum({WEIGHT}), 6) AS horizontal_density,
         count(*) - 1 AS nearby_notes_count
  FROM lanes t JOIN lanes n ON t.song_id = n.song_id AND abs(t.ms - n.ms) <= 117
  GROUP BY ALL)"""

SONGS = """
songlist AS (
  SELECT p_partkey AS id, 'song_' || p_partkey AS name, p_partkey * 7 % 120 + 1 AS difficulty,
         CAST(trunc(p_retailprice) AS BIGINT) AS note_count, p_size AS swf_version
  FROM part)"""

SNAPSHOTS = SONGS + """,
old_songs AS (SELECT * FROM songlist WHERE id % 10 <> 0),
new_songs AS (
  SELECT * REPLACE (CASE WHEN id % 5 = 0 THEN swf_version + 1 ELSE swf_version END AS swf_version)
  FROM songlist WHERE id % 11 <> 0)"""

COUNTED = """
counted AS (
  SELECT id, name, difficulty, swf_version, n.note_count
  FROM songlist JOIN (SELECT user_id, count(*) AS note_count FROM events GROUP BY 1) n ON n.user_id = id)"""

LENGTHS = """
lengths AS (
  SELECT id AS song_id, note_count, swf_version,
         ln(note_count) / ln((SELECT quantile_cont(note_count, 0.95) FROM counted)) AS song_length_log_normalized
  FROM counted)"""

PLAYLIST = """
raw_playlist AS (
  SELECT p_partkey::DOUBLE AS level, 'song_' || p_partkey AS name, (p_partkey * 7 % 120 + 1)::DOUBLE AS difficulty,
         (p_partkey % 15)::DOUBLE AS genre, (p_partkey % 3)::DOUBLE AS style,
         (p_size * 7 // 60) || ':' || lpad((p_size * 7 % 60)::VARCHAR, 2, '0') AS "time",
         (p_size * 10)::DOUBLE AS arrows, 'preview' || p_partkey AS previewhash,
         (946684800 + p_partkey * 86400)::DOUBLE AS releasedate, p_name AS author,
         CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' & ' || p_type ELSE p_brand END AS stepauthor,
         (p_partkey % 5)::DOUBLE AS song_rating, (p_size % 2)::DOUBLE AS o_explicit,
         CASE WHEN p_partkey % 3 <> 0 THEN 1.0::DOUBLE END AS o_legacy,
         CASE WHEN p_partkey % 5 = 0 THEN 1.0::DOUBLE ELSE 0.0 END AS o_unranked,
         CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE END AS credits,
         CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE END AS price
  FROM part)"""

GENRE = """CASE CAST(genre AS INT) WHEN 1 THEN 'Dance' WHEN 2 THEN 'Dance 2' WHEN 3 THEN 'Funk' WHEN 4 THEN 'Arcade'
  WHEN 5 THEN 'Rock' WHEN 6 THEN 'Classical' WHEN 7 THEN 'Misc' WHEN 8 THEN 'Secret' WHEN 9 THEN 'Purchased'
  WHEN 10 THEN 'Token' WHEN 11 THEN 'Hip-Hop' WHEN 12 THEN 'Skill Token' WHEN 13 THEN 'Legacy' END"""

CONTESTED = """
contested AS (
  SELECT 'song_' || l_partkey AS song_name,
         CASE WHEN l_suppkey % 20 = 7 THEN 'no' ELSE CAST(l_quantity AS INT)::VARCHAR END AS old_diff,
         CASE l_linenumber WHEN 1 THEN 'no change' WHEN 2 THEN 'change'
           WHEN 3 THEN '(resolved) ' || (CAST(l_quantity AS INT) + 1)
           WHEN 4 THEN (CAST(l_quantity AS INT) + 4)::VARCHAR WHEN 5 THEN (CAST(l_quantity AS INT) - 8)::VARCHAR
           WHEN 6 THEN '200' ELSE (CAST(l_quantity AS INT) + 2)::VARCHAR END AS new_diff,
         CASE l_suppkey % 10 WHEN 3 THEN NULL WHEN 4 THEN 'v' || strftime(l_shipdate, '%Y/%m/%d')
           WHEN 5 THEN 'n/a' ELSE strftime(l_shipdate, '%Y/%m/%d') END AS "date",
         year(l_shipdate) || ' Difficulty Changes' AS source_sheet,
         row_number() OVER (PARTITION BY year(l_shipdate) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            l_quantity, l_extendedprice) AS sheet_row
  FROM lineitem)"""

PARSED = CONTESTED + """,
dated AS (
  SELECT *, last_value(CAST(try_strptime(trim(replace("date", 'v', '')), '%Y/%m/%d') AS DATE) IGNORE NULLS) OVER (
           PARTITION BY source_sheet ORDER BY sheet_row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS change_date,
         TRY_CAST(substr(source_sheet, 1, 4) AS INT) AS change_year,
         CASE WHEN old_diff <> 'no' THEN TRY_CAST(old_diff AS INT) END AS old_difficulty
  FROM contested),
levels AS (
  SELECT *, CASE WHEN new_diff = 'no change' THEN old_difficulty WHEN new_diff = 'change' THEN NULL
                 WHEN contains(new_diff, '(resolved)') THEN TRY_CAST(regexp_extract(new_diff, '\\(resolved\\)\\s*(\\d+)', 1) AS INT)
                 ELSE TRY_CAST(new_diff AS INT) END AS new_difficulty,
         coalesce(new_diff <> 'no change', true) AS is_actual_change
  FROM dated),
parsed AS (SELECT *, new_difficulty - old_difficulty AS difficulty_change FROM levels)"""

SCORED = PARSED + """,
scored AS (
  SELECT p.*, c.n AS num_changes, 1::DOUBLE / (c.n + 1) AS stability_score,
         CASE WHEN 2001 - change_year <= 0 THEN 1.0::DOUBLE WHEN 2001 - change_year = 1 THEN 0.9
              WHEN 2001 - change_year = 2 THEN 0.8 WHEN 2001 - change_year = 3 THEN 0.7 ELSE 0.6 END AS recency_score,
         CASE WHEN s.difficulty IS NULL THEN 0.7::DOUBLE WHEN new_difficulty = s.difficulty THEN 1.0 ELSE 0.5
              END AS acceptance_score,
         CASE WHEN difficulty_change IS NULL THEN 0.5::DOUBLE WHEN difficulty_change BETWEEN -2 AND 2 THEN 1.0
              WHEN difficulty_change BETWEEN -5 AND 5 THEN 0.8 ELSE 0.6 END AS magnitude_confidence,
         CASE WHEN contains(new_diff, '(resolved)') THEN 0.2::DOUBLE ELSE 0.0 END AS resolution_bonus
  FROM parsed p
  LEFT JOIN (SELECT song_name, count(*) AS n FROM contested GROUP BY 1) c ON c.song_name = p.song_name
  LEFT JOIN songlist s ON s.name = p.song_name),
weighed AS (
  SELECT *, stability_score * recency_score * acceptance_score * magnitude_confidence + resolution_bonus
            AS reliability_weight
  FROM scored),
silver AS (SELECT * FROM weighed WHERE new_difficulty > 0 AND new_difficulty <= 120)"""

LEVELS = """
by_level AS (
  SELECT new_difficulty, avg(reliability_weight) AS avg_reliability, stddev_samp(reliability_weight) AS stddev_reliability,
         count(*) AS num_assessments, sum(reliability_weight) AS total_reliability, avg(recency_score) AS avg_recency,
         avg(acceptance_score) AS avg_acceptance
  FROM silver GROUP BY 1),
dense AS (
  SELECT d.level AS new_difficulty, coalesce(avg_reliability, 0.2::DOUBLE) AS avg_reliability, stddev_reliability,
         coalesce(num_assessments, 0) AS num_assessments, coalesce(total_reliability, 0.2::DOUBLE) AS total_reliability,
         coalesce(avg_recency, 0.6::DOUBLE) AS avg_recency, coalesce(avg_acceptance, 0.7::DOUBLE) AS avg_acceptance
  FROM range(1, 121) d(level) LEFT JOIN by_level ON new_difficulty = d.level),
smoothed AS (
  SELECT * REPLACE (avg(avg_reliability) OVER (ORDER BY new_difficulty ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)
                    AS avg_reliability), avg_reliability AS raw FROM dense)"""

STATS = """round(avg_reliability, 8) AS avg_reliability, round(stddev_reliability, 8) AS stddev_reliability,
  num_assessments, round(total_reliability, 8) AS total_reliability, round(avg_recency, 8) AS avg_recency,
  round(avg_acceptance, 8) AS avg_acceptance"""

SECONDS = NOTES + """,
timed AS (SELECT *, ms / 1000::DOUBLE AS t FROM notes),
separated AS (
  SELECT song_id, note_id, orientation,
         CASE WHEN t = lag(t) OVER (PARTITION BY song_id, orientation ORDER BY t, note_id)
              THEN t + 0.001::DOUBLE ELSE t END AS t
  FROM timed)"""


def oracles() -> dict[str, str]:
    lanes = "WITH " + LANES
    both = lanes + "," + VERTICAL + "," + HORIZONTAL
    scored = "WITH " + SONGS + "," + SCORED
    levels = scored + "," + LEVELS
    snaps = "WITH " + SNAPSHOTS
    song = "id, name, difficulty, swf_version"
    # The same densities on seconds: bounds are thousandths, compared as doubles.
    in_seconds = re.sub(r"(-?\d+)(?=( AND | THEN|$))", lambda m: f"{int(m[1]) / 1000}::DOUBLE", WEIGHT.replace("t.ms - n.ms", "t.ms / 1000::DOUBLE - n.ms / 1000::DOUBLE"))
    seconds = HORIZONTAL.replace(WEIGHT, in_seconds).replace("abs(t.ms - n.ms) <= 117", "abs(t.ms / 1000::DOUBLE - n.ms / 1000::DOUBLE) <= 0.117::DOUBLE")
    ranked = """FROM (SELECT song_name, new_difficulty, change_year, num_changes, source_sheet, sheet_row,
                        round(reliability_weight, 9) AS reliability_weight FROM silver)"""
    means = """(SELECT song_id, avg({c}) AS avg_density FROM {t} GROUP BY 1) a JOIN songlist ON id = song_id"""
    gold = """SELECT v.song_id, v.note_id, v.orientation, vertical_density, horizontal_density,
                round(v.note_id / l.note_count::DOUBLE, 6) AS position_in_song,
                round(song_length_log_normalized, 6) AS song_length_log_normalized, 0 AS hold, 1 AS mine, {version}"""
    joined = """FROM vertical v JOIN horizontal h USING (song_id, note_id, orientation)
                JOIN lengths l ON l.song_id = v.song_id"""
    out = {
        # notes
        "note_1_explode_notes": f"""WITH {NOTES}
            SELECT song_id, note_id, framers, orientation, ms, ms / 1000::DOUBLE AS "timestamp",
                   CASE note_id % 10 WHEN 0 THEN 'blue' WHEN 1 THEN 'red' WHEN 2 THEN 'purple'
                     WHEN 3 THEN 'yellow' WHEN 4 THEN 'pink' WHEN 5 THEN 'orange' WHEN 6 THEN 'cyan'
                     WHEN 7 THEN 'green' WHEN 8 THEN 'white' END AS color
            FROM notes""",
        "note_2_separate_ties": f"WITH {SEPARATED} SELECT song_id, note_id, orientation, ms FROM separated",
        "note_2_separate_ties_seconds": f"""WITH {SECONDS}
            SELECT song_id, note_id, orientation, t AS "timestamp" FROM separated""",
        "note_3_merge_chords": f"WITH {MERGED} SELECT song_id, ms, note_id, framers, orientation FROM merged",
        "note_4_split_chords": f"{lanes} SELECT song_id, note_id, ms, orientation FROM lanes",
        "agg_5_lane_or": f"""WITH {MERGED}
            SELECT song_id, ms, substr(orientation, 1, 3) || '1' AS with_last_lane,
                   substr(orientation, 1, 1) = '1' AS lane_0, substr(orientation, 2, 1) = '1' AS lane_1,
                   substr(orientation, 3, 1) = '1' AS lane_2, substr(orientation, 4, 1) = '1' AS lane_3
            FROM merged""",
        "prj_9_one_hot": """SELECT p_partkey,
                CASE p_size % 6 WHEN 0 THEN '1000' WHEN 1 THEN '0100' WHEN 2 THEN '0010' WHEN 3 THEN '0001' END AS four_lanes,
                CASE p_size % 6 WHEN 0 THEN '100000' WHEN 1 THEN '010000' WHEN 2 THEN '001000' WHEN 3 THEN '000100'
                                WHEN 4 THEN '000010' ELSE '000001' END AS six_lanes
            FROM part""",
        "dq_6_invalid_orientations": f"""WITH {MERGED}
            SELECT song_id, note_id, replace(orientation, '1', '2') AS orientation FROM merged WHERE note_id % 7 = 0""",
        "dq_7_tied_notes": f"""WITH {NOTES}
            SELECT song_id, ms, orientation, count(*) AS note_count FROM notes GROUP BY ALL HAVING count(*) > 1""",
        "srt_3_largest_ties": f"""WITH {NOTES}
            SELECT song_id, ms, orientation, count(*) AS note_count FROM notes GROUP BY ALL HAVING count(*) > 1
            ORDER BY note_count DESC, song_id, ms, orientation LIMIT 5""",
        "dq_7_trace_ties": f"""WITH {MERGED},
            ties AS (
              SELECT DISTINCT song_id AS tied, ms AS tie_ms FROM (
                SELECT song_id, ms, orientation, count(*) AS n FROM notes GROUP BY ALL HAVING count(*) > 1
                ORDER BY n DESC, song_id, ms, orientation LIMIT 5))
            SELECT 'before' AS stage, song_id, tie_ms, note_id, orientation, ms FROM notes JOIN ties
              ON song_id = tied AND ms = tie_ms
            UNION ALL SELECT 'separated', song_id, tie_ms, note_id, orientation, ms FROM separated JOIN ties
              ON song_id = tied AND ms >= tie_ms AND ms < tie_ms + 10
            UNION ALL SELECT 'merged', song_id, tie_ms, note_id, orientation, ms FROM merged JOIN ties
              ON song_id = tied AND ms >= tie_ms AND ms < tie_ms + 10""",
        # densities
        "den_1_vertical_density": f"""{lanes}, {VERTICAL}
            SELECT song_id, note_id, ms, orientation, prev_ms / 1000::DOUBLE AS prev_timestamp,
                   gap / 1000::DOUBLE AS time_delta, vertical_density FROM vertical""",
        "den_1_vertical_density_seconds": f"""WITH {SECONDS},
            merged AS (
              SELECT song_id, t, min(note_id) AS note_id, max(substr(orientation, 1, 1)) || max(substr(orientation, 2, 1))
                     || max(substr(orientation, 3, 1)) || max(substr(orientation, 4, 1)) AS orientation
              FROM separated GROUP BY song_id, t),
            lanes AS (
              SELECT song_id, note_id, t, l.lane AS orientation
              FROM merged JOIN (VALUES (1, '1000'), (2, '0100'), (3, '0010'), (4, '0001')) l(pos, lane)
                ON substr(merged.orientation, l.pos, 1) = '1')
            SELECT song_id, note_id, t AS "timestamp", orientation, p AS prev_timestamp, t - p AS time_delta,
                   CASE WHEN t - p > 0 THEN 1::DOUBLE / (t - p) ELSE 0::DOUBLE END AS vertical_density
            FROM (SELECT *, lag(t) OVER (PARTITION BY song_id, orientation ORDER BY t, note_id) AS p FROM lanes)""",
        "den_3_horizontal_density": f"""{lanes}, {HORIZONTAL}
            SELECT song_id, note_id, orientation, horizontal_density, nearby_notes_count FROM horizontal""",
        "den_3_horizontal_density_by_pairs": f"""{lanes}, {HORIZONTAL}
            SELECT song_id, note_id, ms, orientation, horizontal_density, nearby_notes_count FROM horizontal""",
        "den_3_horizontal_density_seconds": f"""{lanes}, {seconds}
            SELECT song_id, note_id, orientation, horizontal_density, nearby_notes_count FROM horizontal""",
        "den_3_horizontal_density_seconds_prefix": f"""{lanes}, {seconds}
            SELECT song_id, note_id, orientation, horizontal_density, nearby_notes_count FROM horizontal""",
        "den_4_explain_density": f"""{lanes.replace("FROM events)", "FROM events WHERE user_id = (SELECT min(user_id) FROM events))")},
            t AS (SELECT * FROM lanes ORDER BY song_id, note_id DESC, orientation LIMIT 1)
            SELECT n.song_id, n.note_id, n.orientation, n.ms, t.ms - n.ms AS diff_ms, {WEIGHT} AS weight,
                   n.note_id = t.note_id AND n.orientation = t.orientation AS is_self
            FROM lanes n JOIN t ON t.song_id = n.song_id AND abs(t.ms - n.ms) <= 117""",
        "den_note_densities": f"""{both}
            SELECT song_id, note_id, v.ms, orientation, vertical_density, horizontal_density, nearby_notes_count
            FROM vertical v JOIN horizontal h USING (song_id, note_id, orientation)""",
        "jn_5_band_pairs": f"""{lanes}
            SELECT t.song_id, t.note_id, t.orientation, count(*) AS pairs, CAST(sum(t.ms - n.ms) AS BIGINT) AS sum_diff,
                   min(t.ms - n.ms) AS min_diff, max(t.ms - n.ms) AS max_diff
            FROM lanes t JOIN lanes n ON t.song_id = n.song_id AND abs(t.ms - n.ms) <= 117
            GROUP BY ALL""",
        "den_4_verify_density": f"""{lanes}, {HORIZONTAL}
            SELECT song_id, note_id, orientation, horizontal_density AS calculated,
                   nearby_notes_count AS calculated_count, horizontal_density, nearby_notes_count, true AS matches
            FROM horizontal""",
        "dq_9_vertical_by_difficulty": f"""{lanes}, {VERTICAL}, {SONGS}
            SELECT song_id, name, round(avg_density, 6) AS avg_density, difficulty
            FROM {means.format(c='vertical_density', t='vertical')}""",
        "agg_13_density_correlation": f"""{both}, {SONGS}
            SELECT 'vertical_density' AS density, count(*) AS songs, round(corr(avg_density, difficulty), 6) AS correlation
            FROM {means.format(c='vertical_density', t='vertical')} WHERE avg_density <= 150 AND difficulty <= 150
            UNION ALL
            SELECT 'horizontal_density', count(*), round(corr(avg_density, difficulty), 6)
            FROM {means.format(c='horizontal_density', t='horizontal')} WHERE avg_density <= 15 AND difficulty <= 150""",
        # charts
        "cht_1_chart_features": f"""WITH {SONGS}
            SELECT id AS song_id, note_count, swf_version,
                   round(ln(note_count) / ln((SELECT quantile_cont(note_count, 0.95) FROM songlist)), 9)
                     AS song_length_log_normalized
            FROM songlist""",
        "agg_4_percentile": f"WITH {SONGS}, {COUNTED} SELECT quantile_cont(note_count, 0.95) AS p95 FROM counted",
        "agg_4_percentile_of_many_values": " UNION ALL ".join(
            f"SELECT {s}::DOUBLE AS share, round(quantile_cont(l_extendedprice, {s}), 6) AS value FROM lineitem" for s in (0.05, 0.5, 0.95)
        ),
        "cht_1_percentile_after_changes": f"{snaps} SELECT quantile_cont(note_count, 0.95) AS p, count(*) AS songs FROM new_songs",
        "win_3_row_numbers_sliced": """SELECT l_returnflag, year(l_shipdate) AS year, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   row_number() OVER (PARTITION BY l_returnflag ORDER BY year(l_shipdate), l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS nth
            FROM lineitem""",
        "win_3_slice_sizes": "SELECT l_returnflag, count(*) AS \"rows\", true AS bounded, true AS fine FROM lineitem GROUP BY 1",
        "dq_10_length_check": f"""WITH {SONGS}, {COUNTED}, {LENGTHS}
            SELECT count(*) AS total_songs, min(note_count) AS min_notes, max(note_count) AS max_notes,
                   round(avg(note_count), 6) AS avg_notes, round(min(x), 6) AS min_normalized,
                   round(max(x), 6) AS max_normalized, round(avg(x), 6) AS avg_normalized,
                   count(*) FILTER (x <= 1) AS at_or_below, count(*) FILTER (x > 1) AS above,
                   round(count(*) FILTER (x > 1) / count(*)::DOUBLE, 6) AS share_above,
                   count(*) FILTER (x > 1) / count(*)::DOUBLE < 0.1 AS passed
            FROM (SELECT note_count, song_length_log_normalized AS x FROM lengths)""",
        "agg_14_histogram": f"""WITH {SONGS}, {COUNTED},
            r AS (SELECT min(note_count)::DOUBLE AS lo, max(note_count)::DOUBLE AS hi FROM counted),
            placed AS (
              SELECT least(floor((note_count - lo) / (hi - lo) * 10)::BIGINT + 1, 10) AS bin, count(*) AS n
              FROM counted, r GROUP BY 1)
            SELECT b.bin, round(lo + (hi - lo) * (b.bin - 1) / 10, 6) AS bin_low, round(lo + (hi - lo) * b.bin / 10, 6) AS bin_high,
                   coalesce(n, 0) AS n
            FROM range(1, 11) b(bin) CROSS JOIN r LEFT JOIN placed USING (bin)""",
        "agg_14_histogram_lengths": f"""WITH {SONGS}, {COUNTED}, {LENGTHS},
            v AS (SELECT round(song_length_log_normalized, 4) AS x FROM lengths),
            r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
            placed AS (SELECT least(floor((x - lo) / (hi - lo) * 50)::BIGINT + 1, 50) AS bin, count(*) AS n FROM v, r GROUP BY 1)
            SELECT b.bin, round(lo + (hi - lo) * (b.bin - 1) / 50, 6) AS bin_low, round(lo + (hi - lo) * b.bin / 50, 6) AS bin_high,
                   coalesce(n, 0) AS n
            FROM range(1, 51) b(bin) CROSS JOIN r LEFT JOIN placed USING (bin)""",
        # change detection
        "cdc_1_deleted_keys": f"{snaps} SELECT id FROM old_songs ANTI JOIN new_songs USING (id)",
        "cdc_2_new_keys": f"{snaps} SELECT id FROM new_songs ANTI JOIN old_songs USING (id)",
        "cdc_3_updated_keys": f"""{snaps}
            SELECT id, o.swf_version AS previous_swf_version, n.swf_version AS new_swf_version
            FROM old_songs o JOIN new_songs n USING (id) WHERE o.swf_version <> n.swf_version""",
        "cdc_4_changed_keys": f"""{snaps}
            SELECT id FROM new_songs n LEFT JOIN old_songs o USING (id)
            WHERE o.name IS NULL OR o.swf_version <> n.swf_version""",
        "cdc_4_changed_keys_null_safe": f"""{snaps}
            SELECT id FROM new_songs n LEFT JOIN old_songs o USING (id)
            WHERE o.name IS NULL OR o.swf_version <> n.swf_version OR id % 7 = 0""",
        "cdc_5_combined_keys": f"""{snaps}
            SELECT id FROM new_songs n LEFT JOIN old_songs o USING (id)
            WHERE o.name IS NULL OR o.swf_version <> n.swf_version""",
        "cdc_6_version_missing": f"""{snaps}
            SELECT id, n.swf_version AS new_swf_version FROM old_songs JOIN new_songs n USING (id)""",
        "cdc_6_changes_by_content": f"""{snaps}
            SELECT id, CASE WHEN o.swf_version IS NULL THEN 'new' WHEN n.swf_version IS NULL THEN 'deleted' ELSE 'updated' END AS kind
            FROM (SELECT {song} FROM old_songs) o FULL JOIN (SELECT {song} FROM new_songs) n USING (id)
            WHERE (o.name, o.difficulty, o.swf_version) IS DISTINCT FROM (n.name, n.difficulty, n.swf_version)""",
        "cdc_7_scope": f"""{snaps}, {NOTES}
            SELECT song_id, event_id, ms FROM raw_notes WHERE song_id IN (
              SELECT id FROM new_songs n LEFT JOIN old_songs o USING (id)
              WHERE o.name IS NULL OR o.swf_version <> n.swf_version)""",
        "cdc_8_change_summary": f"""{snaps}
            SELECT count(*) FILTER (o.id IS NULL) AS "new",
                   count(*) FILTER (o.swf_version <> n.swf_version) AS updated,
                   count(*) FILTER (n.id IS NULL) AS deleted,
                   count(*) FILTER (o.swf_version = n.swf_version) AS unchanged,
                   count(*) FILTER (o.id IS NULL OR o.swf_version <> n.swf_version) AS to_process
            FROM old_songs o FULL JOIN new_songs n ON o.id = n.id""",
        "cdc_10_with_version": f"""{snaps}
            SELECT user_id AS song_id, event_id, swf_version FROM events JOIN new_songs ON id = user_id""",
        "cdc_settle_versions": f"""{snaps}
            SELECT id, CASE WHEN id % 2 = 0 THEN n.swf_version ELSE o.swf_version END AS swf_version
            FROM new_songs n LEFT JOIN old_songs o USING (id)""",
        # table changes
        "dml_1_merge_upsert": f"""{snaps}
            SELECT {song} FROM new_songs UNION ALL SELECT {song} FROM old_songs ANTI JOIN new_songs USING (id)""",
        "dml_2_delete_keys": f"{snaps} SELECT {song} FROM old_songs SEMI JOIN new_songs USING (id)",
        "dml_3_delete_where": f"WITH {SONGS} SELECT {song} FROM songlist WHERE swf_version NOT IN (3, 7, 11)",
        "dml_4_replace_by_key": f"""WITH {NOTES},
            incoming AS (SELECT song_id, event_id, ms + 1000 AS ms FROM raw_notes WHERE song_id % 3 = 0 AND event_id % 2 = 0)
            SELECT song_id, event_id, ms FROM incoming UNION ALL
            SELECT song_id, event_id, ms FROM raw_notes WHERE song_id NOT IN (SELECT song_id FROM incoming)""",
        "dml_5_cascade_report": f"""{snaps},
            gone AS (SELECT id FROM old_songs ANTI JOIN new_songs USING (id)),
            held AS (SELECT 'bronze__songlist' AS "table", id FROM old_songs
                     UNION ALL SELECT 'bronze__playlist', p_partkey FROM part
                     UNION ALL SELECT 'silver__notes', user_id FROM events)
            SELECT "table", count(*) AS rows_before, count(gone.id) AS rows_deleted,
                   count(*) - count(gone.id) AS rows_after
            FROM held LEFT JOIN gone ON gone.id = held.id GROUP BY 1""",
        "dml_5_cascade_rows": f"""{snaps}
            SELECT user_id AS song_id, event_id FROM events WHERE user_id NOT IN (
              SELECT id FROM old_songs ANTI JOIN new_songs USING (id))""",
        "dml_6_update_where": f"""WITH {SONGS}
            SELECT id, name, CASE WHEN id % 9 = 4 THEN difficulty + swf_version ELSE difficulty END AS difficulty,
                   CASE WHEN id % 9 = 4 THEN 999999 ELSE swf_version END AS swf_version
            FROM songlist""",
        "dml_7_merge_update": f"""{snaps}
            SELECT id, CASE WHEN n.id IS NULL THEN o.name WHEN id % 4 <> 0 THEN n.name || '_b' END AS name,
                   o.difficulty, o.swf_version
            FROM old_songs o LEFT JOIN new_songs n USING (id)""",
        # decoding
        "prj_1_decode_genre": f"WITH {PLAYLIST} SELECT level, {GENRE} AS genre FROM raw_playlist",
        "prj_11_clean_playlist": f"""WITH {PLAYLIST}
            SELECT {GENRE} AS genre, name, difficulty, style, p_size * 7 AS song_length, level AS song_id,
                   arrows AS num_arrows, previewhash AS preview_id, releasedate::BIGINT AS release_date, author,
                   replace(stepauthor, ' & ', '|') AS stepauthor, song_rating, coalesce(o_explicit = 1, false) AS explicit_flag,
                   coalesce(o_legacy = 1, false) AS legacy_flag, coalesce(o_unranked = 1, false) AS unranked_flag,
                   coalesce(credits, 0) AS credits, coalesce(price, 0) AS price, p_size AS swf_version
            FROM raw_playlist JOIN part ON p_partkey = level""",
        "prj_4_parse_fields": f"""WITH {PLAYLIST}
            SELECT level, p_size * 7 AS seconds, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END AS authors,
                   year(to_timestamp(releasedate) AT TIME ZONE 'UTC') AS release_year, CAST(NULL AS INT) AS bad_time
            FROM raw_playlist JOIN part ON p_partkey = level""",
        "fn_6_map_update": f"""WITH {NOTES}
            SELECT song_id, (note_id - 1) // 4096 * 4096 + 1 AS first_note_id, 'song_' || song_id AS name, '99999' AS note_count, 2 AS entries
            FROM notes GROUP BY ALL""",
        # reliability
        "rel_2_forward_fill": f"""WITH {PARSED}
            SELECT source_sheet, sheet_row, strftime(change_date, '%Y-%m-%d') AS change_date FROM parsed""",
        "rel_4_parse_disputes": f"""WITH {PARSED}
            SELECT source_sheet, sheet_row, old_difficulty, new_difficulty, change_year, is_actual_change,
                   difficulty_change FROM parsed""",
        "rel_12_reliability_weights": f"""{scored}
            SELECT song_name, old_difficulty, new_difficulty, difficulty_change, is_actual_change, change_year,
                   source_sheet, num_changes, round(stability_score, 9) AS stability_score, recency_score, acceptance_score,
                   magnitude_confidence, resolution_bonus, round(reliability_weight, 9) AS reliability_weight,
                   strftime(change_date, '%Y-%m-%d') AS change_date
            FROM weighed""",
        "flt_1_dq_counts": f"""{scored}
            SELECT count(*) AS rows_before, count(*) FILTER (new_difficulty IS NULL) AS removed_not_null,
                   count(*) FILTER (new_difficulty <= 0) AS removed_positive,
                   count(*) FILTER (new_difficulty > 120) AS removed_max,
                   count(*) FILTER (new_difficulty > 0 AND new_difficulty <= 120) AS rows_after
            FROM weighed""",
        "rel_13_song_consensus": f"""{scored}
            SELECT song_name, round(sum(new_difficulty * reliability_weight) / sum(reliability_weight) + 1e-11::DOUBLE, 9) AS weighted_difficulty,
                   round(avg(reliability_weight) + 1e-11::DOUBLE, 9) AS avg_reliability, round(sum(reliability_weight) + 1e-11::DOUBLE, 9) AS total_reliability,
                   count(*) AS num_assessments, strftime(max(change_date), '%Y-%m-%d') AS latest_change,
                   round(stddev_samp(new_difficulty) + 1e-11::DOUBLE, 9) AS difficulty_stddev,
                   min(new_difficulty) AS min_contested_difficulty, max(new_difficulty) AS max_contested_difficulty
            FROM silver GROUP BY 1""",
        "rel_13_consensus_after_changes": f"""{scored}
            SELECT song_name, round(sum(new_difficulty * reliability_weight) / sum(reliability_weight) + 1e-9::DOUBLE, 7) AS weighted_difficulty,
                   round(avg(reliability_weight) + 1e-9::DOUBLE, 7) AS avg_reliability, round(sum(reliability_weight) + 1e-9::DOUBLE, 7) AS total_reliability,
                   count(*) AS num_assessments, strftime(max(change_date), '%Y-%m-%d') AS latest_change,
                   round(stddev_samp(new_difficulty) + 1e-9::DOUBLE, 7) AS difficulty_stddev,
                   min(new_difficulty) AS min_contested_difficulty, max(new_difficulty) AS max_contested_difficulty
            FROM silver GROUP BY 1""",
        "rel_14_difficulty_reliability": f"{levels} SELECT new_difficulty, {STATS} FROM by_level",
        "rel_14_reliability_after_changes": f"{levels} SELECT new_difficulty, {STATS} FROM by_level",
        "rel_15_densify": f"{levels} SELECT new_difficulty, {STATS} FROM dense",
        "rel_16_reliability_scores": f"{levels} SELECT new_difficulty, {STATS} FROM smoothed",
        "rel_16_reliability_scores_even": f"""{levels.replace('3 PRECEDING', '2 PRECEDING')}
            SELECT new_difficulty, {STATS} FROM smoothed""",
        "rel_17_sample_weights": f"""{levels}
            SELECT id AS song_id, difficulty, num_assessments, round(coalesce(avg_reliability, 0.2::DOUBLE), 6) AS sample_weight
            FROM songlist LEFT JOIN smoothed ON new_difficulty = difficulty""",
        "dq_1_null_counts": f"""{scored}
            SELECT count(*) FILTER (song_name IS NULL) AS song_name, count(*) FILTER (old_difficulty IS NULL) AS old_difficulty,
                   count(*) FILTER (new_difficulty IS NULL) AS new_difficulty, count(*) FILTER (change_date IS NULL) AS change_date,
                   count(*) FILTER (difficulty_change IS NULL) AS difficulty_change,
                   count(*) FILTER (reliability_weight IS NULL) AS reliability_weight
            FROM weighed""",
        "dq_2_profile": f"""{scored}
            SELECT count(d) AS "count", round(avg(d), 6) AS mean, round(stddev_samp(d), 6) AS stddev, min(d) AS "min",
                   quantile_disc(d, 0.25) AS p25, quantile_disc(d, 0.5) AS p50, quantile_disc(d, 0.75) AS p75, max(d) AS "max"
            FROM (SELECT difficulty_change AS d FROM silver WHERE is_actual_change)""",
        "dq_2_weight_profile": f"""{scored}
            SELECT count(d) AS "count", round(avg(d), 6) AS mean, round(stddev_samp(d), 6) AS stddev, min(d) AS "min",
                   quantile_disc(d, 0.25) AS p25, quantile_disc(d, 0.5) AS p50, quantile_disc(d, 0.75) AS p75, max(d) AS "max"
            FROM (SELECT round(reliability_weight, 9) AS d FROM silver)""",
        "dq_3_changes_by_year": f"{scored} SELECT change_year, count(*) AS \"count\" FROM silver GROUP BY 1",
        "dq_4_highest_weights": f"""{scored} SELECT * {ranked}
            ORDER BY reliability_weight DESC, source_sheet, sheet_row LIMIT 10""",
        "dq_4_lowest_weights": f"""{scored} SELECT * {ranked}
            ORDER BY reliability_weight, source_sheet, sheet_row LIMIT 10""",
        "dq_5_resolved": f"""WITH {CONTESTED}
            SELECT song_name, old_diff, new_diff, source_sheet, sheet_row FROM contested
            WHERE contains(new_diff, '(resolved)')""",
        "srt_2_top_songs": f"""{scored}
            SELECT song_name, round(sum(reliability_weight), 8) AS total_reliability, count(*) AS num_assessments
            FROM silver GROUP BY 1 ORDER BY total_reliability DESC, song_name LIMIT 10""",
        "dq_8_smoothing_report": f"""{levels}
            SELECT new_difficulty, round(raw, 6) AS before_smooth, round(avg_reliability, 6) AS after_smooth,
                   round(avg_reliability - raw, 6) + 0.0::DOUBLE AS "change", num_assessments
            FROM smoothed WHERE new_difficulty % 10 = 0 OR num_assessments = 0""",
        "agg_16_smoothing_ranges": f"""{levels}
            SELECT round(min(raw), 6) AS min_before, round(max(raw), 6) AS max_before,
                   round(min(avg_reliability), 6) AS min_after, round(max(avg_reliability), 6) AS max_after,
                   round(avg(raw), 6) AS mean_before, round(avg(abs(avg_reliability - raw)), 6) AS mean_abs_change,
                   round(max(avg_reliability - raw), 6) AS max_increase, round(min(avg_reliability - raw), 6) AS max_decrease
            FROM smoothed""",
        "dq_12_weight_coverage": f"""{levels},
            w AS (SELECT avg_reliability, coalesce(avg_reliability, 0.2::DOUBLE) AS x
                  FROM songlist LEFT JOIN smoothed ON new_difficulty = difficulty)
            SELECT count(*) AS songs, count(avg_reliability) AS with_score, count(*) - count(avg_reliability) AS with_default,
                   round(min(x), 6) AS min_weight, round(max(x), 6) AS max_weight, round(avg(x), 6) AS mean_weight,
                   round(stddev_samp(x), 6) AS stddev_weight
            FROM w""",
        # gold
        "gld_2_assemble_features": f"""{both}, {SONGS}, {COUNTED}, {LENGTHS}
            {gold.format(version='swf_version')} {joined}""",
        "gld_3_attach_labels": f"""{levels}
            SELECT user_id AS song_id, event_id, difficulty, round(avg_reliability, 6) AS sample_weight
            FROM events LEFT JOIN songlist ON id = user_id
            LEFT JOIN smoothed ON new_difficulty = difficulty""",
        "gld_features": f"""{both}, {SONGS}, {COUNTED}, {LENGTHS}, {SCORED}, {LEVELS}
            {gold.format(version='l.swf_version')}, difficulty, round(avg_reliability, 6) AS sample_weight
            {joined} JOIN songlist s ON s.id = v.song_id LEFT JOIN smoothed ON new_difficulty = s.difficulty""",
        "gld_features_from_tables": f"""{both}, {SONGS}, {COUNTED}, {LENGTHS}, {SCORED}, {LEVELS}
            {gold.format(version='l.swf_version')}, difficulty, round(avg_reliability, 6) AS sample_weight
            {joined} JOIN songlist s ON s.id = v.song_id LEFT JOIN smoothed ON new_difficulty = s.difficulty""",
        # files and tables
        "src_1_songlist_json": f"WITH {SONGS} SELECT {song}, note_count FROM songlist",
        "src_1_songlist_json_array": f"WITH {SONGS} SELECT {song}, note_count FROM songlist",
        "src_3_playlist_json_array": f"WITH {PLAYLIST} SELECT * FROM raw_playlist",
        "src_2_charts_json": f"""WITH {NOTES}
            SELECT * FROM (
              SELECT song_id, note_id, framers, orientation, ms,
                     CASE note_id % 10 WHEN 0 THEN 'blue' WHEN 1 THEN 'red' WHEN 2 THEN 'purple'
                       WHEN 3 THEN 'yellow' WHEN 4 THEN 'pink' WHEN 5 THEN 'orange' WHEN 6 THEN 'cyan'
                       WHEN 7 THEN 'green' WHEN 8 THEN 'white' END AS color
              FROM notes) WHERE song_id % 5 <> 0""",
        "src_3_playlist_json": f"WITH {PLAYLIST} SELECT * FROM raw_playlist",
        "src_4_read_sheets": f"""WITH {CONTESTED}
            SELECT song_name, old_diff, new_diff, "date", source_sheet, sheet_row FROM contested""",
        "src_4_read_sheets_multiline": f"""WITH {CONTESTED}
            SELECT CASE WHEN sheet_row % 3 = 0 THEN song_name || chr(10) || chr(10) || '"live", ' || old_diff || '"' || chr(10) ELSE song_name END AS song_name,
                   old_diff, new_diff, "date", source_sheet, sheet_row FROM contested""",
        "snk_1_overwrite_append": f"{snaps} SELECT {song} FROM old_songs UNION ALL SELECT {song} FROM new_songs",
        "snk_3_recreate_add_column": f"WITH {SONGS} SELECT id, swf_version, CAST(NULL AS INT) AS difficulty FROM songlist",
        "snk_publish_upsert": f"""{snaps}
            SELECT {song} FROM new_songs UNION ALL SELECT {song} FROM old_songs ANTI JOIN new_songs USING (id)""",
        "snk_replace_songs": f"""WITH {NOTES},
            incoming AS (SELECT song_id, event_id, ms + 1000 AS ms FROM raw_notes WHERE song_id % 3 = 0 AND event_id % 2 = 0)
            SELECT song_id, event_id, ms FROM incoming UNION ALL
            SELECT song_id, event_id, ms FROM raw_notes WHERE song_id NOT IN (SELECT song_id FROM incoming)""",
        "set_2_union_by_name": f"""{snaps}
            SELECT id, name, CAST(NULL AS BIGINT) AS swf_version, CAST(NULL AS INT) AS difficulty FROM old_songs
            UNION ALL SELECT id, NULL, swf_version, NULL FROM new_songs
            UNION ALL SELECT id, NULL, NULL, difficulty FROM old_songs""",
        "run_incremental_gold": f"""{both}, {SONGS},
            counted AS (
              SELECT id, name, difficulty,
                     CASE WHEN id % 5 = 0 THEN swf_version + 1 ELSE swf_version END AS swf_version, n.note_count
              FROM songlist JOIN (SELECT user_id, count(*) AS note_count FROM events GROUP BY 1) n ON n.user_id = id
              WHERE id % 11 <> 0),
            {LENGTHS},
            {SCORED.replace('LEFT JOIN songlist s', 'LEFT JOIN (SELECT * FROM songlist SEMI JOIN events ON user_id = id) s')},
            {LEVELS}
            {gold.format(version='l.swf_version')}, difficulty, round(avg_reliability, 6) AS sample_weight
            {joined} JOIN songlist s ON s.id = v.song_id LEFT JOIN smoothed ON new_difficulty = s.difficulty""",
        "run_duplicate_payloads": f"""WITH {SONGS}
            SELECT user_id AS song_id, count(*) AS notes, count(*) AS last_note
            FROM events JOIN songlist ON id = user_id WHERE user_id % 11 <> 0 GROUP BY 1""",
        "run_idle": f"""WITH {SONGS},
            s AS (SELECT count(DISTINCT user_id) AS listed, count(DISTINCT user_id) FILTER (user_id % 7 <> 0) AS laned
                  FROM events JOIN songlist ON id = user_id WHERE user_id % 11 <> 0)
            SELECT 'bronze__charts' AS "table", 'skip' AS mode, listed AS songs FROM s
            UNION ALL SELECT 'silver__notes', 'skip', listed FROM s
            UNION ALL SELECT 'silver__notes_adjusted', 'skip', listed FROM s
            UNION ALL SELECT 'silver__vertical_density', 'skip', laned FROM s
            UNION ALL SELECT 'silver__horizontal_density', 'skip', laned FROM s
            UNION ALL SELECT 'gold__features', 'skip', laned FROM s""",
        "snk_bucket_count": f"""WITH {NOTES}
            SELECT song_id, count(*) AS notes, 4 AS buckets FROM raw_notes
            WHERE song_id % 5 <> 0 OR event_id % 2 = 1 GROUP BY 1""",
        "src_2_charts_decimals": f"""WITH {NOTES}
            SELECT song_id, count(*) AS notes, sum(ms)::BIGINT AS sum_ms, sum(framers)::BIGINT AS sum_framers, max(note_id) AS last_note,
                   (SELECT count(*) FROM part) AS rejected
            FROM notes GROUP BY 1""",
        "aud_1_presence": f"""{snaps},
            found AS (SELECT 'bronze' AS layer, 'bronze__songlist' AS "table", id FROM new_songs
                      UNION ALL SELECT 'bronze', 'bronze__playlist', p_partkey FROM part
                      UNION ALL SELECT 'silver', 'silver__notes', user_id FROM events
                      UNION ALL SELECT 'gold', 'gold__features', id FROM old_songs)
            SELECT t.layer, t."table", s.id AS key, count(f.id) AS "rows"
            FROM songlist s CROSS JOIN (VALUES ('bronze', 'bronze__songlist'), ('bronze', 'bronze__playlist'),
                   ('silver', 'silver__notes'), ('gold', 'gold__features')) t(layer, "table")
            LEFT JOIN found f ON f.id = s.id AND f."table" = t."table" GROUP BY ALL""",
        "aud_2_verdict": f"""{snaps}
            SELECT s.id AS key,
                   CASE WHEN b.id IS NULL AND n.user_id IS NULL AND g.id IS NULL THEN 'clean'
                        WHEN b.id IS NOT NULL AND n.user_id IS NULL AND g.id IS NULL THEN 'bronze'
                        WHEN b.id IS NOT NULL AND n.user_id IS NOT NULL AND g.id IS NULL THEN 'silver'
                        WHEN b.id IS NOT NULL AND n.user_id IS NOT NULL AND g.id IS NOT NULL THEN 'full'
                        ELSE 'partial' END AS state
            FROM songlist s LEFT JOIN new_songs b ON b.id = s.id LEFT JOIN old_songs g ON g.id = s.id
            LEFT JOIN (SELECT DISTINCT user_id FROM events) n ON n.user_id = s.id""",
        "aud_3_staleness": f"""WITH {SONGS},
            n AS (SELECT user_id, count(*) AS c FROM events GROUP BY 1)
            SELECT 'bronze' AS layer, 'bronze__songlist' AS "table", id::VARCHAR AS key, 1 AS "rows",
                   CASE WHEN id % 9 = 4 THEN 1 ELSE 0 END AS stale_rows,
                   CASE WHEN id % 9 = 4 THEN 'failed' ELSE 'updated' END AS status FROM songlist
            UNION ALL
            SELECT 'silver', 'silver__notes', id::VARCHAR, coalesce(c, 0), CASE WHEN id % 4 = 0 THEN coalesce(c, 0) ELSE 0 END,
                   CASE WHEN c IS NULL OR id % 4 = 0 THEN 'pending' ELSE 'updated' END
            FROM songlist LEFT JOIN n ON user_id = id
            UNION ALL SELECT 'gold', 'gold__features', id::VARCHAR, 1, 0, 'updated' FROM songlist""",
    }
    for name in ("den_1_vertical_density", "den_3_horizontal_density", "den_note_densities", "rel_2_forward_fill"):
        out[f"{name}_sliced"] = out[name]
    return out
