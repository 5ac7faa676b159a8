"""The same results as plain SQL over the driver's tables, one statement for each registered query."""

from __future__ import annotations

_CTES = {
    "obs": """
        SELECT CAST(user_id AS VARCHAR) AS series_id, event_type AS series_name, CAST(ts AS DATE) AS date,
               CASE WHEN event_type = 'error' THEN '.' ELSE CAST(value AS VARCHAR) END AS raw_value,
               value, ts AS run_timestamp
        FROM events""",
    "typed": """
        SELECT series_id, series_name, date, run_timestamp, TRY_CAST(NULLIF(raw_value, '.') AS DOUBLE) AS value
        FROM obs""",
    "meta": """
        SELECT CAST(c_custkey AS VARCHAR) AS series_id, c_name AS friendly_name, c_mktsegment AS units
        FROM customer""",
    "big": """
        SELECT CAST(l_partkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS value
        FROM lineitem""",
    "bmeta": """
        SELECT CAST(p_partkey AS VARCHAR) AS series_id, p_name AS title, p_brand AS friendly_name, p_type AS units
        FROM part""",
    "cat": """
        SELECT * FROM (VALUES ('click', 'Clicks'), ('view', 'Views'), ('purchase', 'Purchases'),
                              ('signup', 'Sign-ups'), ('refund', 'Refunds')) AS t(series_id, friendly_name)""",
}


def _with(names: str, statement: str) -> str:
    ctes = ", ".join(f"{n} AS ({_CTES[n].strip()})" for n in names.split())
    return f"WITH {ctes} {statement.strip()}"


_LATEST = """
    SELECT series_id, date, value, series_name FROM (
        SELECT *, row_number() OVER (PARTITION BY series_id, date ORDER BY run_timestamp DESC, series_name DESC, value DESC) AS rn
        FROM {table}) AS ranked
    WHERE rn = 1"""

_TABLE_BIG = "SELECT series_id, date, value FROM big"

_STATEMENTS = {
    "d1_gold_join": ("big bmeta", """
        SELECT b.series_id, b.date, b.value, m.title, m.friendly_name, m.units, 'SRC' AS source
        FROM big b JOIN bmeta m ON b.series_id = m.series_id"""),
    "d2_gold_current": ("obs meta", """
        SELECT o.series_id, o.date, o.value, m.friendly_name, m.units, 'SRC' AS source
        FROM (SELECT *, row_number() OVER (PARTITION BY series_id, date ORDER BY run_timestamp DESC, value DESC) AS rn FROM obs) o
        JOIN meta m ON o.series_id = m.series_id WHERE o.rn = 1"""),
    "d4_orphan_count": ("", """
        SELECT 'Orphaned documents (no label)' AS check_name, count(*) AS "count"
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL"""),
    "d5_orphans_by_key": ("", """
        SELECT d.source AS series_id, count(*) AS orphaned_records
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL GROUP BY 1"""),
    "d5_orphans_by_series": ("big obs", """
        SELECT series_id, count(*) AS orphaned_records FROM big
        WHERE series_id NOT IN (SELECT series_id FROM obs) GROUP BY 1"""),
    "d6_dimension_without_facts": ("obs meta", """
        SELECT m.series_id, m.friendly_name FROM meta m LEFT JOIN obs o ON m.series_id = o.series_id
        WHERE o.series_id IS NULL"""),
    "d7_latest_values": ("obs meta", """
        SELECT o.series_id, m.friendly_name, o.date, o.value, m.units
        FROM obs o JOIN meta m ON o.series_id = m.series_id
        WHERE o.date = (SELECT max(date) FROM obs g WHERE g.series_id = o.series_id)"""),
    "d7_latest_listing": ("big bmeta", """
        SELECT b.series_id, m.friendly_name, b.date, b.value, m.units
        FROM big b JOIN bmeta m ON b.series_id = m.series_id
        WHERE b.date = (SELECT max(date) FROM big g WHERE g.series_id = b.series_id)"""),
    "d8_referential_filter": ("", """
        SELECT d.doc_id, d.lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""),
    "d9_calendar_gaps": ("big", """
        SELECT DISTINCT date FROM big WHERE date < DATE '1995-06-01' OR date > DATE '2001-06-30'"""),
    "e6_latest_wins": ("obs", _LATEST.format(table="obs")),
    "f1_latest_wins_ranked": ("obs", _LATEST.format(table="obs")),
    "e6_latest_wins_large": ("", """
        SELECT series_id, date, run, line, value FROM (
            SELECT l_partkey AS series_id, CAST(l_shipdate AS DATE) AS date, l_orderkey AS run, l_linenumber AS line,
                   l_extendedprice AS value,
                   row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                                      ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
            FROM lineitem) AS ranked
        WHERE rn = 1"""),
    "e7_drop_duplicates": ("obs", """
        SELECT series_id, date, value FROM (
            SELECT *, row_number() OVER (PARTITION BY series_id, date ORDER BY run_timestamp, series_name, raw_value, value) AS rn
            FROM obs) AS ranked
        WHERE rn = 1"""),
    "f2_latest_only": ("obs", """
        SELECT series_id, date, value FROM (
            SELECT *, row_number() OVER (PARTITION BY series_id
                                         ORDER BY date DESC, run_timestamp DESC, series_name DESC, raw_value DESC, value DESC) AS rn
            FROM obs) AS ranked
        WHERE rn = 1"""),
    "c1_typed_projection": ("obs", """
        SELECT TRY_CAST(series_id AS INTEGER) AS series_no,
               TRY_CAST(strftime(run_timestamp, '%Y-%m-%d') AS DATE) AS date,
               strftime(run_timestamp, '%Y-%m-%d %H:%M:%S') AS run_ts_text,
               strftime(run_timestamp, '%Y%m%d_%H%M%S') AS file_stamp
        FROM obs"""),
    "c7_null_violations": ("obs typed", """
        SELECT series_id, date, series_name FROM typed WHERE series_id IS NULL OR date IS NULL OR value IS NULL"""),
    "c8_missing_marker": ("obs typed", "SELECT series_id, date, value FROM typed WHERE value IS NOT NULL"),
    "c9_out_of_range": ("obs", "SELECT series_id, date, value FROM obs WHERE NOT (value BETWEEN -5 AND 25)"),
    "c10_future_dates": ("obs", "SELECT series_id, date FROM obs WHERE date > DATE '2024-01-21'"),
    "c11_id_format": ("", """
        SELECT n_name, regexp_matches(n_name, '^[A-Z0-9_]+$') AS ok, upper(n_name) = n_name AS is_upper FROM nation"""),
    "c11_id_format_large": ("bmeta", """
        SELECT friendly_name, regexp_matches(friendly_name, '^[A-Z0-9_]+$') AS ok,
               upper(friendly_name) = friendly_name AS is_upper, count(*) AS n
        FROM bmeta GROUP BY 1, 2, 3"""),
    "c12_membership": ("obs", """
        SELECT series_id, date, series_name FROM obs WHERE series_name IN ('click', 'view')"""),
    "c12_missing_members": ("obs cat", """
        SELECT series_id FROM cat WHERE series_id NOT IN (SELECT series_name FROM obs)"""),
    "i6_clean_text": ("", r"""
        SELECT doc_id, trim(regexp_replace(regexp_replace(COALESCE(text, ''), '\r\n|\n|\r', ' ', 'g'), ' {2,}', ' ', 'g'),
                            E' \t\n\r') AS notes
        FROM documents"""),
    "i12_catalog_lookup": ("obs cat", """
        SELECT o.series_id, o.date, o.value, c.friendly_name
        FROM obs o LEFT JOIN cat c ON o.series_name = c.series_id"""),
    "a7_batch_read": ("", "SELECT event_id, event_type, value FROM events"),
    "a8_payload_explode": ("obs typed", """
        SELECT series_id, date, value FROM typed
        UNION ALL SELECT series_id, CAST(date + 1 AS DATE) AS date, value FROM obs"""),
    "a9_payload_first": ("meta", "SELECT series_id, friendly_name, units FROM meta"),
    "a10_catalog": ("obs cat", """
        SELECT c.series_id, c.friendly_name, count(o.series_name) AS n
        FROM cat c LEFT JOIN obs o ON o.series_name = c.series_id GROUP BY 1, 2"""),
    "a12_date_range": ("obs", """
        SELECT series_id, date, value FROM obs WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""),
    "e1_layer_counts": ("obs typed meta", """
        SELECT 'bronze_observations' AS layer_table, count(*) AS "rows" FROM typed
        UNION ALL SELECT 'silver_observations', count(*) FROM typed WHERE value IS NOT NULL
        UNION ALL SELECT 'silver_metadata', count(*) FROM meta"""),
    "h2_concat": ("obs big", """
        SELECT series_id, date, value FROM obs UNION ALL SELECT series_id, date, value FROM big"""),
    "h2_concat_missing_columns": ("obs big", """
        SELECT series_id, date, series_name, CAST(NULL AS DOUBLE) AS value FROM obs
        UNION ALL SELECT series_id, date, NULL, value FROM big"""),
    "e2_coverage": ("obs meta", """
        SELECT m.series_id, m.friendly_name, m.units, count(o.date) AS observation_count,
               min(o.date) AS first_date, max(o.date) AS last_date
        FROM meta m LEFT JOIN obs o ON m.series_id = o.series_id GROUP BY 1, 2, 3"""),
    "e2_coverage_copies": ("obs meta", """
        SELECT m.series_id, m.friendly_name, m.units, count(o.date) AS observation_count,
               min(o.date) AS first_date, max(o.date) AS last_date
        FROM (SELECT * FROM meta UNION ALL SELECT * FROM meta) m LEFT JOIN obs o ON m.series_id = o.series_id
        GROUP BY 1, 2, 3"""),
    "e3_freshness": ("obs", """
        SELECT series_id, max(date) AS latest_date,
               CAST(date_diff('day', max(date), DATE '2024-02-15') AS INTEGER) AS days_since_update
        FROM obs GROUP BY 1"""),
    "e4_null_counts": ("obs typed", """
        SELECT count(*) FILTER (WHERE series_id IS NULL) AS null_series_id,
               count(*) FILTER (WHERE date IS NULL) AS null_dates,
               count(*) FILTER (WHERE value IS NULL) AS null_values
        FROM typed"""),
    "e5_max_count": ("big", "SELECT max(date) AS latest_date, count(*) AS row_count FROM big"),
    "e8_resample_month": ("big", """
        SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS period, round(avg(value), 6) AS value
        FROM big GROUP BY 1, 2"""),
    "e8_resample_week": ("obs", """
        SELECT series_id, CAST(date_trunc('week', date) AS DATE) AS period, max(value) AS value, count(value) AS n
        FROM obs GROUP BY 1, 2"""),
    "e8_resample_quarter": ("obs", """
        SELECT series_id, CAST(date_trunc('quarter', date) AS DATE) AS period, min(value) AS value, count(value) AS n
        FROM obs GROUP BY 1, 2"""),
    "e8_resample_year_last": ("big", """
        SELECT series_id, period, value FROM (
            SELECT series_id, CAST(date_trunc('year', date) AS DATE) AS period, value,
                   row_number() OVER (PARTITION BY series_id, date_trunc('year', date) ORDER BY date DESC, value DESC) AS rn
            FROM big) AS ranked
        WHERE rn = 1"""),
    "e8_resample_day_sum": ("obs", """
        SELECT series_id, date AS period, round(sum(value), 4) AS value FROM obs GROUP BY 1, 2"""),
    "e9_pk_duplicates": ("", """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""),
    "e10_distinct_series": ("big", "SELECT count(DISTINCT series_id) AS n_series FROM big"),
    "e11_rows_per_series_run": ("obs", """
        SELECT series_id, date AS run_date, count(*) AS n FROM obs GROUP BY 1, 2"""),
    "g3_first_n": ("obs", "SELECT series_id, date, value FROM obs ORDER BY date, run_timestamp LIMIT 10"),
    "k1_expect_or_drop": ("obs typed", """
        SELECT series_id, date, value FROM typed WHERE value IS NOT NULL AND value BETWEEN 0 AND 100"""),
    "k2_fail_mode": ("obs", "SELECT series_id, date, value FROM obs WHERE value IS NOT NULL"),
    "k3_warn_mode": ("obs typed", "SELECT series_id, date, value FROM typed"),
    "k4_rule_metrics": ("obs typed", """
        SELECT 'value_not_null' AS rule, count(*) FILTER (WHERE value IS NULL) AS failed,
               count(*) FILTER (WHERE value IS NOT NULL) AS passed FROM typed
        UNION ALL
        SELECT 'in_range', count(*) FILTER (WHERE NOT COALESCE(value BETWEEN 0 AND 100, FALSE)),
               count(*) FILTER (WHERE COALESCE(value BETWEEN 0 AND 100, FALSE)) FROM typed"""),
    "k5_primary_key": ("", """
        SELECT CAST(COALESCE(sum(n) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL), 0) AS BIGINT) AS null_keys,
               count(*) FILTER (WHERE n > 1 AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) AS duplicate_keys
        FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) AS per_key"""),
    "k8_quarantine": ("obs typed", """
        SELECT series_id, date,
               concat_ws(',', CASE WHEN value IS NULL THEN 'value_not_null' END,
                         CASE WHEN NOT COALESCE(value BETWEEN 0 AND 100, FALSE) THEN 'in_range' END) AS failed_rules
        FROM typed WHERE NOT COALESCE(value BETWEEN 0 AND 100, FALSE)"""),
    "k9_report": ("obs typed meta", """
        SELECT 'Null series_id' AS check_name, count(*) AS "count" FROM typed WHERE series_id IS NULL
        UNION ALL SELECT 'Null date', count(*) FROM typed WHERE date IS NULL
        UNION ALL SELECT 'Null value', count(*) FROM typed WHERE value IS NULL
        UNION ALL SELECT 'Value out of range', count(*) FROM typed WHERE NOT (value BETWEEN 0 AND 100)
        UNION ALL SELECT 'Date in the future', count(*) FROM typed WHERE date > DATE '2024-01-21'
        UNION ALL SELECT 'Malformed series_id', count(*) FROM typed WHERE NOT regexp_matches(series_id, '^[A-Z0-9_]+$')
        UNION ALL SELECT 'Orphaned observations (no metadata)', count(*) FROM typed
                  WHERE series_id NOT IN (SELECT series_id FROM meta)
        UNION ALL SELECT 'Duplicate series_id in metadata', count(*)
                  FROM (SELECT series_id FROM meta GROUP BY 1 HAVING count(*) > 1) AS duplicates"""),
    "a3_inferred_schema": ("obs typed", """
        SELECT CAST(series_id AS INTEGER) AS series_id, series_name, date, value FROM typed"""),
    "a4_schema_evolution": ("obs typed", """
        SELECT series_id, CASE WHEN run_timestamp >= TIMESTAMP '2024-01-15' THEN series_name END AS series_name, date, value
        FROM typed"""),
    "a5_load_by_pattern": ("obs typed", """
        SELECT series_id, series_name, date, value FROM typed WHERE run_timestamp < TIMESTAMP '2024-01-15'"""),
    "a13_payload_status": ("", """
        SELECT 'refund' AS series_id, 'missing' AS status, CAST(0 AS BIGINT) AS responses
        UNION ALL
        SELECT event_type, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'empty' ELSE 'ok' END, count(*)
        FROM events GROUP BY 1, 2"""),
    "a13_fetch": ("obs typed cat", """
        SELECT '2024-02-01 08:00:00' AS run_timestamp, t.series_name AS series_id, c.friendly_name AS series_name,
               t.date, t.value
        FROM typed t JOIN cat c ON t.series_name = c.series_id
        WHERE t.series_name <> 'signup' AND t.date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"""),
    "b3_append_merged": ("obs", """
        SELECT series_id, date, value, CAST(NULL AS VARCHAR) AS series_name FROM obs
        UNION ALL SELECT series_id, date, NULL, series_name FROM obs"""),
    "b1_csv_snapshot": ("obs typed", """
        SELECT series_id, series_name, date, value, strftime(run_timestamp, '%Y-%m-%d %H:%M:%S') AS run FROM typed"""),
    "b2_json_snapshot": ("meta", """
        SELECT series_id, friendly_name, friendly_name AS title, units, CAST(series_id AS INTEGER) AS popularity, '' AS notes
        FROM meta"""),
    "b5_view_refresh": ("big", "SELECT series_id, date, value + 1 AS value FROM big"),
    "b8_clustered_table": ("big", _TABLE_BIG),
    "b9_compacted_table": ("big", _TABLE_BIG),
    "j4_stream_silver": ("obs typed", """
        SELECT series_id, series_name, date, value FROM typed WHERE value IS NOT NULL"""),
    "j5_stream_drop_redelivered": ("obs", """
        SELECT DISTINCT series_id, date, strftime(run_timestamp, '%Y-%m-%d %H:%M:%S') AS run FROM obs"""),
    "j6_stream_upsert": ("obs", _LATEST.format(table="obs")),
    "j8_stream_metrics": ("obs typed meta", """
        SELECT 'silver_observations' AS flow, 'fk_series_id_not_null' AS rule,
               count(*) FILTER (WHERE series_id IS NULL) AS failed, count(series_id) AS passed FROM typed
        UNION ALL SELECT 'silver_observations', 'date_not_null', count(*) FILTER (WHERE date IS NULL), count(date) FROM typed
        UNION ALL SELECT 'silver_observations', 'value_not_null', count(*) FILTER (WHERE value IS NULL), count(value) FROM typed
        UNION ALL SELECT 'silver_metadata', 'pk_series_id_not_null', count(*) FILTER (WHERE series_id IS NULL), count(series_id) FROM meta"""),
    **dict.fromkeys(("j9_stream_gold", "j9_late_revision", "b5_incremental_view"), ("obs typed meta", """
        SELECT o.series_id, o.date, o.value, m.friendly_name AS title, m.friendly_name, m.units, 'SRC' AS source
        FROM (SELECT *, row_number() OVER (PARTITION BY series_id, date
                                           ORDER BY date_trunc('second', run_timestamp) DESC, value DESC) AS rn
              FROM typed WHERE value IS NOT NULL) o
        JOIN meta m ON o.series_id = m.series_id WHERE o.rn = 1""")),
    "a8_large_response": ("obs typed cat", """
        SELECT '2024-02-01 08:00:00' AS run_timestamp, t.series_name AS series_id,
               CASE t.series_name WHEN 'error' THEN 'Errors' ELSE c.friendly_name END AS series_name, t.date, t.value
        FROM typed t LEFT JOIN cat c ON t.series_name = c.series_id
        WHERE (c.series_id IS NOT NULL OR t.series_name = 'error') AND t.date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"""),
    "a11_landed_rows": ("obs", """
        SELECT CASE WHEN run_timestamp < TIMESTAMP '2024-01-15' THEN 'early' ELSE 'late' END AS run,
               count(*) AS "rows", TRUE AS has_bytes FROM obs GROUP BY 1"""),
    "a13_fetch_metadata": ("bmeta", """
        SELECT '2024-02-01 08:00:00' AS run_timestamp, series_id, 'Part ' || series_id AS friendly_name, title, units,
               '' AS frequency, 'a b ' || friendly_name AS notes FROM bmeta WHERE units <> 'ECONOMY'"""),
    "b7_described_table": ("obs typed", """
        SELECT series_id, date, value, 'silver' AS quality, 'observed value' AS comment FROM typed WHERE value IS NOT NULL"""),
    "b8_layout": ("", "SELECT CAST(0 AS BIGINT) AS overlapping, count(*) AS n, TRUE AS many FROM lineitem"),
    "b8_streamed_layout": ("obs typed meta", """
        SELECT 'bronze_metadata' AS "table", CAST(0 AS BIGINT) AS overlapping, count(*) AS n, TRUE AS many FROM meta
        UNION ALL SELECT 'silver_metadata', 0, count(*), TRUE FROM meta
        UNION ALL SELECT 'bronze_observations', 0, count(*), TRUE FROM typed
        UNION ALL SELECT 'silver_observations', 0, count(*), TRUE FROM typed WHERE value IS NOT NULL"""),
    "b9_compacted": ("big", "SELECT series_id, date, value, TRUE AS fewer_files FROM big"),
    "c5_audit_stamps": ("obs typed", """
        SELECT series_id, date, '2024-02-15 00:00:00' AS stamp FROM typed
        UNION ALL SELECT series_id, date, '2024-02-16 10:00:00' FROM typed WHERE value IS NOT NULL"""),
    "h3_empty_result": ("", """
        SELECT '' AS run_timestamp, '' AS series_id, '' AS series_name, DATE '2024-01-01' AS date, CAST(0 AS DOUBLE) AS value
        FROM events WHERE FALSE"""),
    "i3_offset_timestamps": ("obs", """
        SELECT series_id, date, strftime(run_timestamp + CASE series_name WHEN 'click' THEN INTERVAL 6 HOUR
               WHEN 'view' THEN INTERVAL (-330) MINUTE WHEN 'purchase' THEN INTERVAL 0 HOUR END, '%Y-%m-%d %H:%M:%S') AS utc
        FROM obs"""),
    "i12_catalog_join": ("obs meta", """
        SELECT o.series_id, o.date, o.value, m.friendly_name FROM obs o LEFT JOIN meta m ON o.series_id = m.series_id"""),
    "j2_continuous": ("obs typed", "SELECT series_id, series_name, date, value FROM typed"),
    "k2_refused": ("obs typed", """
        SELECT 'good' AS batch, CAST(0 AS BIGINT) AS broken, count(*) AS published FROM obs
        UNION ALL SELECT 'bad', count(*) FILTER (WHERE value IS NULL), 0 FROM typed
        UNION ALL SELECT 'filtered', -1, 0"""),
    "k8_stream_quarantine": ("obs typed", """
        SELECT series_id, date, value, CASE WHEN value IS NULL THEN 'value_not_null' ELSE '' END AS failed_rules FROM typed"""),
    "a4_stream_evolution": ("obs typed", """
        SELECT series_id, CASE WHEN run_timestamp < TIMESTAMP '2024-01-25' THEN series_name END AS series_name, date, value
        FROM typed WHERE value IS NOT NULL"""),
    "j5_late_run": ("obs", """
        SELECT DISTINCT series_id, date, strftime(run_timestamp, '%Y-%m-%d %H:%M:%S') AS run FROM obs
        UNION SELECT series_id, date, NULL FROM obs WHERE series_name = 'click'"""),
}


def statements() -> dict[str, str]:
    return {
        name: _with(ctes, statement) if ctes else statement.strip() for name, (ctes, statement) in _STATEMENTS.items()
    }
