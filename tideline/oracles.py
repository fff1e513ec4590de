"""SQL for DuckDB that gives the same rows as the queries of the same names."""

LISTINGS = """
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(user_id AS VARCHAR) AS u FROM events),
raw AS (
  SELECT 'src' || CAST(user_id % 2 AS VARCHAR) AS source, CAST(CAST(ts AS DATE) AS VARCHAR) AS crawl_date, 'c' || CAST(event_id % 3 AS VARCHAR) AS crawl_id,
    CASE WHEN user_id % 10 <> 0 THEN u END AS listing_id,
    CASE WHEN user_id % 30 <> 0 THEN 'https://Ex.test/ad/' || u || '/?e=' || CAST(event_id AS VARCHAR) END AS listing_url,
    ' Ad ' || u || ' ' AS title_raw, 'k' || CAST(k % 5 AS VARCHAR) AS description_raw,
    CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) END AS price_vnd,
    CASE WHEN event_type = 'signup' THEN 'negotiable' WHEN event_type <> 'error' THEN 'vnd' END AS price_unit,
    CASE WHEN k >= 10 THEN CAST(k AS DOUBLE) END AS area_m2,
    CASE WHEN user_id % 3 <> 0 THEN 'city' || CAST(user_id % 2 AS VARCHAR) END AS city_norm,
    CASE WHEN k % 11 <> 0 THEN 'd' || CAST(user_id % 7 AS VARCHAR) END AS district_norm,
    CASE WHEN k % 4 = 0 THEN 'near' END AS location_raw,
    CASE user_id % 4 WHEN 0 THEN 'apartment' WHEN 1 THEN 'house' WHEN 2 THEN 'land' ELSE 'street_house' END AS property_type_group,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS processed_at, event_id
  FROM e),
listings AS (
  SELECT *, price_vnd / area_m2 AS unit_price_vnd_m2, coalesce(price_unit = 'negotiable', FALSE) AS is_price_negotiable,
    price_vnd IS NULL AND NOT coalesce(price_unit = 'negotiable', FALSE) AS is_missing_price, area_m2 IS NULL AS is_missing_area,
    location_raw IS NULL AND district_norm IS NULL AND city_norm IS NULL AS is_missing_location,
    coalesce(price_vnd <= 0, FALSE) AS is_invalid_price, coalesce(area_m2 <= 0, FALSE) AS is_invalid_area,
    CASE WHEN (price_vnd IS NULL AND NOT coalesce(price_unit = 'negotiable', FALSE)) OR area_m2 IS NULL
      OR (location_raw IS NULL AND district_norm IS NULL AND city_norm IS NULL) THEN 'partial_success' ELSE 'success' END AS parse_status
  FROM raw),
keyed AS (
  SELECT *, CASE WHEN listing_id IS NOT NULL THEN source || '::' || listing_id
      WHEN listing_url IS NOT NULL THEN source || '::' || regexp_replace(lower(regexp_extract(listing_url, '^[^?#]+')), '/+$', '')
      ELSE source || '::' || sha256(source || '||' || lower(trim(title_raw)) || '||' || coalesce(lower(district_norm), '') || '||' || coalesce(CAST(area_m2 AS VARCHAR), '') || '||' || coalesce(CAST(price_vnd AS VARCHAR), '')) END AS dedup_key,
    CASE WHEN listing_id IS NOT NULL THEN 'listing_id' WHEN listing_url IS NOT NULL THEN 'listing_url' ELSE 'content_hash' END AS dedup_method
  FROM listings)"""

FLAGGED = f"""{LISTINGS},
flagged AS (
  SELECT *, count(*) OVER (PARTITION BY crawl_date, dedup_key) AS duplicate_group_size, count(*) OVER (PARTITION BY crawl_date, dedup_key) > 1 AS is_duplicate_in_snapshot FROM keyed)"""

DAILY = f"""{FLAGGED},
scored AS (
  SELECT *, CAST((CASE WHEN parse_status = 'success' THEN 10 ELSE 0 END) + (CASE WHEN price_vnd IS NOT NULL THEN 5 ELSE 0 END)
    + (CASE WHEN price_unit = 'negotiable' THEN 3 ELSE 0 END) + (CASE WHEN area_m2 IS NOT NULL THEN 5 ELSE 0 END)
    + (CASE WHEN district_norm IS NOT NULL THEN 3 ELSE 0 END) + (CASE WHEN location_raw IS NOT NULL THEN 2 ELSE 0 END) AS INTEGER) AS quality_score FROM flagged),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY crawl_date, dedup_key ORDER BY quality_score DESC, processed_at DESC NULLS LAST, crawl_id DESC NULLS LAST, listing_url DESC NULLS LAST, event_id DESC) AS place FROM scored),
daily AS (SELECT * EXCLUDE (place) FROM placed WHERE place = 1)"""

SNAPSHOTS = f"""{DAILY},
lived AS (
  SELECT *, crawl_date AS snapshot_date, min(crawl_date) OVER (PARTITION BY dedup_key) AS first_seen_date, max(crawl_date) OVER (PARTITION BY dedup_key) AS last_seen_date,
    count(*) OVER (PARTITION BY dedup_key) AS active_days FROM daily),
lagged AS (
  SELECT *, crawl_date = first_seen_date AS is_new_listing, lag(price_vnd) OVER w AS previous_price_vnd, lag(area_m2) OVER w AS previous_area_m2, lag(title_raw) OVER w AS previous_title_raw,
    lag(description_raw) OVER w AS previous_description_raw, lag(district_norm) OVER w AS previous_district_norm, lag(property_type_group) OVER w AS previous_property_type_group
  FROM lived WINDOW w AS (PARTITION BY dedup_key ORDER BY crawl_date)),
priced AS (
  SELECT *, price_vnd - previous_price_vnd AS price_change_vnd, CASE WHEN previous_price_vnd <> 0 THEN (price_vnd - previous_price_vnd) / previous_price_vnd END AS price_change_pct,
    coalesce(previous_price_vnd <> price_vnd AND price_unit <> 'negotiable', FALSE) AS is_price_changed,
    concat_ws(',', CASE WHEN previous_price_vnd <> price_vnd THEN 'price_vnd' END, CASE WHEN previous_area_m2 <> area_m2 THEN 'area_m2' END, CASE WHEN previous_title_raw <> title_raw THEN 'title_raw' END,
      CASE WHEN previous_description_raw <> description_raw THEN 'description_raw' END, CASE WHEN previous_district_norm <> district_norm THEN 'district_norm' END,
      CASE WHEN previous_property_type_group <> property_type_group THEN 'property_type_group' END) AS changed_fields
  FROM lagged),
snap AS (
  SELECT *, changed_fields <> '' AS is_info_changed, CASE WHEN NOT is_new_listing AND is_price_changed THEN 'changed_price' WHEN is_new_listing THEN 'new' ELSE 'active' END AS snapshot_status FROM priced)"""

REMOVED = f"""{DAILY},
days AS (SELECT crawl_date, lead(crawl_date) OVER (ORDER BY crawl_date) AS next_date FROM (SELECT DISTINCT crawl_date FROM daily)),
removed AS (
  SELECT d.*, y.next_date FROM daily d JOIN days y ON d.crawl_date = y.crawl_date
  WHERE y.next_date IS NOT NULL AND NOT EXISTS (SELECT 1 FROM daily n WHERE n.dedup_key = d.dedup_key AND n.crawl_date = y.next_date))"""

_MARKET = """count(*) AS listing_count, quantile_disc(price_vnd, 0.5) AS median_price_vnd, quantile_disc(area_m2, 0.5) AS median_area_m2, round(quantile_disc(unit_price_vnd_m2, 0.5), 6) AS median_unit_price_vnd_m2,
  round(avg(price_vnd), 4) AS avg_price_vnd, count(*) FILTER (WHERE snapshot_status = 'new') AS new_listing_count, count(*) FILTER (WHERE is_price_changed) AS price_changed_count,
  count(*) FILTER (WHERE price_unit = 'negotiable') AS negotiable_price_count"""

QUALITY = f"""{FLAGGED},
counted AS (
  SELECT crawl_date, source, count(*) AS total_records, count(*) FILTER (WHERE parse_status = 'success') AS parse_success_count, count(*) FILTER (WHERE is_missing_price) AS missing_price_count,
    count(*) FILTER (WHERE is_price_negotiable) AS negotiable_price_count, count(*) FILTER (WHERE is_missing_area) AS missing_area_count, count(*) FILTER (WHERE is_missing_location) AS missing_location_count,
    count(*) FILTER (WHERE is_invalid_price) AS invalid_price_count, count(*) FILTER (WHERE is_invalid_area) AS invalid_area_count, count(*) FILTER (WHERE is_duplicate_in_snapshot) AS duplicate_record_count,
    count(DISTINCT dedup_key) AS distinct_dedup_key_count
  FROM flagged GROUP BY crawl_date, source),
quality AS (
  SELECT *, parse_success_count / total_records AS parse_success_rate, missing_price_count / total_records AS missing_price_rate, negotiable_price_count / total_records AS negotiable_price_rate,
    missing_area_count / total_records AS missing_area_rate, missing_location_count / total_records AS missing_location_rate, invalid_price_count / total_records AS invalid_price_rate,
    invalid_area_count / total_records AS invalid_area_rate, duplicate_record_count / total_records AS duplicate_rate FROM counted)"""

MARKET = f"""{SNAPSHOTS},
market AS (
  SELECT snapshot_date, city_norm, district_norm, property_type_group, {_MARKET}, round(avg(unit_price_vnd_m2), 6) AS avg_unit_price_vnd_m2
  FROM snap GROUP BY snapshot_date, city_norm, district_norm, property_type_group)"""

RUNS = """
o AS (SELECT *, o_orderkey AS k FROM orders),
runs AS (
  SELECT k, CAST(k AS VARCHAR) AS run_id, CASE WHEN k % 3 = 0 THEN 'smoke' WHEN k % 3 = 1 THEN 'full' ELSE 'reparse' END AS pipeline_mode, CASE WHEN k % 3 = 0 THEN 'smoke' WHEN k % 3 = 1 THEN 'production' ELSE 'manual' END AS run_class,
    CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN 'failed' ELSE 'success' END AS pipeline_status, CASE WHEN k % 5 = 0 THEN 'fail' ELSE 'passed' END AS validation_status, k % 300 AS records,
    CASE WHEN k % 4 = 0 THEN ['a', 'b'] WHEN k % 4 = 1 THEN ['a'] ELSE [] END AS source_names FROM o),
decided AS (
  SELECT *, CASE WHEN run_class <> 'production' THEN 'skipped' WHEN pipeline_status <> 'success' OR validation_status = 'fail' OR records < 100 THEN 'blocked' ELSE 'published' END AS publish_status,
    CASE WHEN run_class <> 'production' THEN NULL WHEN pipeline_status <> 'success' THEN 'pipeline_status=failed' WHEN validation_status = 'fail' THEN 'validation_status=fail' WHEN records <= 0 THEN 'no records'
      WHEN records < 100 THEN 'records ' || records || ' below minimum 100' END AS publish_block_reason FROM runs)"""

_GOLD_CHECKS = """['absent_fields', 'absent_tables', 'total_records_positive', 'current_rows_positive', 'duplicate_rate_in_range', 'parse_success_rate_in_range', 'missing_price_rate_in_range', 'missing_area_rate_in_range',
  'missing_location_rate_in_range', 'current_rows_match', 'current_listings_rows', 'current_listings_columns', 'current_listings_days', 'snapshots_rows', 'snapshots_columns', 'snapshots_days', 'market_by_district_rows',
  'market_by_district_columns', 'market_by_district_days', 'market_by_type_rows', 'market_by_type_columns', 'market_by_type_days', 'data_quality_rows', 'data_quality_columns', 'data_quality_days', 'removed_listings_rows',
  'removed_listings_columns', 'removed_listings_days']"""
_TABLES = ("dim_date", "dim_source", "dim_property_type", "dim_location", "dim_listing", "fact_listing", "fact_quality")
_STAR_CHECKS = str(
    [f"{t}_{k}" for t in _TABLES for k in ("rows", "columns", "repeated")]
    + [f"{t}_unknown" for t in ("dim_source", "dim_property_type", "dim_location")]
    + [f"dim_listing_{k}_orphans" for k in ("source_key", "first_seen_date_key", "last_seen_date_key")]
    + [f"fact_listing_{k}_orphans" for k in ("date_key", "source_key", "listing_key", "location_key", "property_type_key")]
    + ["fact_quality_date_key_orphans", "fact_quality_source_key_orphans", "fact_grain"]
)
LOG = """
log AS (
  SELECT *, event_id AS i, user_id % 10 AS part, CASE WHEN event_id % 9 = 0 THEN 403 WHEN event_id % 9 = 1 THEN 429 WHEN event_id % 9 = 2 THEN 500 WHEN event_id % 9 <> 3 THEN 200 END AS status FROM events),
judged AS (
  SELECT *, CASE WHEN status = 403 THEN 'http_403' WHEN status = 429 THEN 'http_429' WHEN i % 3 = 0 AND i % 5 = 0 THEN 'cloudflare_challenge' WHEN i % 3 = 0 AND i % 7 = 0 THEN 'captcha' END AS block_reason,
    CASE WHEN status IN (403, 429) THEN 'blocked' WHEN status IS NOT NULL THEN 'failed_http' WHEN i % 2 = 0 THEN 'failed_timeout' ELSE 'failed_fetch' END AS class FROM log)"""

_SOURCES = """SELECT *, n_nationkey AS k, CAST(n_nationkey % 10 = 3 AS INTEGER) + CAST(n_nationkey % 8 = 1 AS INTEGER) + CAST(n_nationkey % 9 = 1 AS INTEGER) + CAST(n_nationkey % 6 = 0 AS INTEGER) + CAST(n_nationkey % 7 = 0 AS INTEGER)
        + CAST(n_nationkey % 8 = 0 AS INTEGER) + CAST(n_nationkey % 9 = 0 AS INTEGER) + CAST(n_nationkey % 10 = 0 AS INTEGER) + CAST(n_nationkey % 13 = 5 AS INTEGER) + CAST(n_nationkey % 4 = 2 AS INTEGER) + CAST(n_nationkey < 5 AS INTEGER)
        + CAST(n_nationkey % 5 <> 4 AND n_nationkey <= 0 AS INTEGER) AS reasons FROM nation"""
SNAP_COLUMNS = "dedup_key, snapshot_date, snapshot_status, is_new_listing, price_vnd, previous_price_vnd, price_change_vnd, price_change_pct, is_price_changed"

ORACLES = {
    "dedup_key": f"WITH {LISTINGS} SELECT event_id, dedup_key, dedup_method FROM keyed",
    "duplicate_flags": f"WITH {FLAGGED} SELECT event_id, duplicate_group_size, is_duplicate_in_snapshot FROM flagged",
    "daily_dedup": f"WITH {DAILY} SELECT crawl_date, dedup_key, event_id, quality_score FROM daily",
    "lifecycle": f"WITH {DAILY} SELECT dedup_key, min(crawl_date) AS first_seen_date, max(crawl_date) AS last_seen_date, count(*) AS active_days FROM daily GROUP BY dedup_key",
    "price_changes": f"WITH {SNAPSHOTS} SELECT {SNAP_COLUMNS} FROM snap",
    "info_changes": f"""WITH {SNAPSHOTS} SELECT dedup_key, snapshot_date, previous_price_vnd, previous_area_m2, previous_title_raw, previous_description_raw, previous_district_norm, previous_property_type_group,
      coalesce(previous_area_m2 <> area_m2, FALSE) AS is_area_m2_changed, coalesce(previous_title_raw <> title_raw, FALSE) AS is_title_raw_changed, coalesce(previous_description_raw <> description_raw, FALSE) AS is_description_raw_changed,
      coalesce(previous_district_norm <> district_norm, FALSE) AS is_district_norm_changed, coalesce(previous_property_type_group <> property_type_group, FALSE) AS is_property_type_group_changed, changed_fields, is_info_changed FROM snap""",
    "removed_listings": f"WITH {REMOVED} SELECT dedup_key, next_date AS snapshot_date, crawl_date AS last_seen_before_removed, event_id, 'removed' AS snapshot_status FROM removed",
    "current_listings": f"WITH {SNAPSHOTS} SELECT dedup_key, snapshot_date, event_id, snapshot_status FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY snapshot_date DESC) AS rn FROM snap) WHERE rn = 1",
    "market_by_district": f"WITH {MARKET} SELECT * FROM market",
    "market_by_type": f"WITH {SNAPSHOTS} SELECT snapshot_date, property_type_group, {_MARKET} FROM snap GROUP BY snapshot_date, property_type_group",
    "data_quality_daily": f"WITH {QUALITY} SELECT * FROM quality",
    "status_counts": f"WITH {SNAPSHOTS} SELECT snapshot_date, snapshot_status, count(*) AS n FROM snap GROUP BY snapshot_date, snapshot_status",
    "dedup_methods": f"WITH {LISTINGS} SELECT dedup_method, count(*) AS n FROM keyed GROUP BY dedup_method",
    "top_districts": f"WITH {MARKET} SELECT district_norm, CAST(sum(listing_count) AS BIGINT) AS listings FROM market WHERE district_norm IS NOT NULL GROUP BY district_norm ORDER BY listings DESC, district_norm LIMIT 20",
    "top_median_districts": f"WITH {MARKET} SELECT district_norm, median(median_price_vnd) AS median_of_medians FROM market WHERE district_norm IS NOT NULL AND median_price_vnd IS NOT NULL GROUP BY district_norm ORDER BY 2 DESC, 1 LIMIT 20",
    "quality_long": f"WITH {QUALITY} SELECT crawl_date, source, 'parse_success_rate' AS metric, parse_success_rate AS value FROM quality UNION ALL SELECT crawl_date, source, 'duplicate_rate', duplicate_rate FROM quality",
    "rolling_baseline": f"""WITH {QUALITY}, b AS (SELECT crawl_date, source, duplicate_rate, avg(duplicate_rate) OVER (PARTITION BY source ORDER BY crawl_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS base FROM quality)
      SELECT crawl_date, source, round(duplicate_rate, 9) AS duplicate_rate, round(base, 9) AS duplicate_rate_baseline, round(duplicate_rate - base, 9) AS duplicate_rate_delta FROM b""",
    "source_gate": f"WITH {QUALITY} SELECT crawl_date, source, CASE WHEN parse_success_rate < 0.9 OR missing_price_rate > 0.5 OR missing_area_rate > 0.5 OR missing_location_rate > 0.5 OR duplicate_rate > 0.5 THEN 'fail' ELSE 'pass' END AS gate FROM quality",
    "quality_class": f"WITH {QUALITY} SELECT crawl_date, source, CASE WHEN parse_success_rate >= 0.95 AND duplicate_rate < 0.1 THEN 'excellent' WHEN parse_success_rate >= 0.9 THEN 'good' ELSE 'poor' END AS class FROM quality",
    "gold_summary": f"""WITH {QUALITY}, t AS (SELECT CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(duplicate_record_count) AS BIGINT) AS duplicate_record_count FROM quality)
      SELECT total_records, duplicate_record_count, duplicate_record_count / total_records AS duplicate_rate, (SELECT count(DISTINCT crawl_date) FROM keyed) AS days FROM t""",
    "explorer_filters": f"""WITH {SNAPSHOTS}, cur AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY snapshot_date DESC) AS rn FROM snap)
      SELECT dedup_key, price_vnd, price_unit FROM cur WHERE rn = 1 AND price_unit IS DISTINCT FROM 'negotiable' AND property_type_group IN ('house', 'land') AND (price_vnd BETWEEN 1000 AND 200000 OR price_vnd IS NULL)""",
    "dim_date": f"""WITH {LISTINGS}, d AS (SELECT DISTINCT CAST(crawl_date AS DATE) AS d FROM keyed)
      SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_value, CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(week(d) AS INTEGER) AS week_of_year,
      CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend FROM d""",
    "dim_source": "SELECT 0 AS source_key, 'unknown' AS source_code, 'Unknown' AS source_name, CAST(NULL AS VARCHAR) AS source_domain, 'website' AS source_type, FALSE AS is_active",
    "dim_property_type": f"""WITH {LISTINGS}, g AS (SELECT DISTINCT property_type_group AS g FROM keyed UNION SELECT 'unknown'),
      b AS (SELECT g, CASE WHEN g IN ('apartment', 'house') THEN 'residential' WHEN g = 'land' THEN 'land' ELSE 'unknown' END AS b FROM g)
      SELECT CASE WHEN g = 'unknown' THEN '0000000000000000' ELSE left(sha256(b || '|' || g), 16) END AS property_type_key, b AS business_type, g AS property_type_group, g AS property_type_code,
      CASE g WHEN 'street_house' THEN 'Street House' ELSE upper(left(g, 1)) || substr(g, 2) END AS property_type_label, b = 'residential' AS is_residential, b = 'land' AS is_land, b = 'commercial' AS is_commercial FROM b""",
    "dim_location": f"""WITH {SNAPSHOTS}, l AS (SELECT DISTINCT coalesce(city_norm, 'unknown') AS c, coalesce(district_norm, 'unknown') AS d FROM snap UNION SELECT 'unknown', 'unknown')
      SELECT CASE WHEN c = 'unknown' AND d = 'unknown' THEN '0000000000000000' ELSE left(sha256('vn|' || c || '|' || d || '|unknown'), 16) END AS location_key, c AS city_code, d AS district_code, 'unknown' AS ward_code,
      CASE WHEN d <> 'unknown' THEN 'district' WHEN c <> 'unknown' THEN 'city' ELSE 'unknown' END AS location_level, CAST(CASE WHEN d <> 'unknown' THEN 0.7 WHEN c <> 'unknown' THEN 0.4 ELSE 0.0 END AS DOUBLE) AS location_confidence FROM l""",
    "dim_listing": f"""WITH {SNAPSHOTS}, k AS (SELECT *, coalesce(listing_id, lower(listing_url), lower(dedup_key)) AS v, snapshot_date || '|' || dedup_key AS o, CAST(strftime(CAST(snapshot_date AS DATE), '%Y%m%d') AS INTEGER) AS day FROM snap)
      SELECT left(sha256(source || '|' || v), 16) AS listing_key, 0 AS source_key, min(listing_id) AS source_listing_id, arg_min(lower(listing_url), o) FILTER (WHERE listing_url IS NOT NULL) AS source_listing_url, arg_min(dedup_key, o) AS dedup_key,
      min(day) AS first_seen_date_key, max(day) AS last_seen_date_key, CASE WHEN min(listing_id) IS NOT NULL THEN 'listing_id' WHEN min(listing_url) IS NOT NULL THEN 'listing_url' ELSE 'dedup_key' END AS listing_identity_method,
      CAST(NULL AS DOUBLE) AS frontage_width_m, CAST(NULL AS VARCHAR) AS project_name, CAST(NULL AS VARCHAR) AS building_name, CAST(NULL AS VARCHAR) AS direction, CAST(NULL AS VARCHAR) AS seller_type FROM k GROUP BY source, v""",
    "fact_listing": f"""WITH {SNAPSHOTS}, k AS (SELECT *, coalesce(listing_id, lower(listing_url), lower(dedup_key)) AS v,
        CASE WHEN property_type_group IN ('apartment', 'house') THEN 'residential' WHEN property_type_group = 'land' THEN 'land' ELSE 'unknown' END AS b FROM snap)
      SELECT CAST(strftime(CAST(snapshot_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key, 0 AS source_key, left(sha256(source || '|' || v), 16) AS listing_key,
      CASE WHEN city_norm IS NULL AND district_norm IS NULL THEN '0000000000000000' ELSE left(sha256('vn|' || coalesce(city_norm, 'unknown') || '|' || coalesce(district_norm, 'unknown') || '|unknown'), 16) END AS location_key,
      left(sha256(b || '|' || property_type_group), 16) AS property_type_key, price_vnd, area_m2, round(unit_price_vnd_m2, 6) AS unit_price_vnd_m2, CAST(NULL AS INTEGER) AS bedroom_count, CAST(NULL AS INTEGER) AS bathroom_count,
      CAST(NULL AS INTEGER) AS floor_count, quality_score, price_change_vnd, price_change_pct, CAST(NULL AS DOUBLE) AS frontage_width_m, is_new_listing, is_price_changed, is_info_changed, FALSE AS has_legal_info, FALSE AS has_car_access,
      is_price_negotiable, FALSE AS has_red_pink_book, FALSE AS is_business_suitable, FALSE AS has_urban_area_flag, FALSE AS has_security_flag, FALSE AS has_educated_community_flag, FALSE AS has_high_intellect_flag,
      FALSE AS has_residential_area_flag, FALSE AS has_subdivision_flag, CAST(NULL AS VARCHAR) AS legal_status_raw, CAST(NULL AS VARCHAR) AS furniture_level, CAST(NULL AS VARCHAR) AS car_access_type, snapshot_status,
      TRUE AS is_active_listing, FALSE AS is_removed_listing, dedup_key FROM k""",
    "fact_quality": f"""WITH {QUALITY} SELECT CAST(strftime(CAST(crawl_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key, 0 AS source_key, total_records, parse_success_count, duplicate_record_count, missing_price_count, missing_area_count,
      missing_location_count, CAST(0 AS BIGINT) AS quarantine_count, parse_success_rate, duplicate_rate, missing_price_rate, missing_area_rate, missing_location_rate, FALSE AS publish_blocked_flag
      FROM (SELECT *, row_number() OVER (PARTITION BY crawl_date ORDER BY source) AS rn FROM quality) WHERE rn = 1""",
    "warehouse_checks": "SELECT * FROM (VALUES ('orphan_location', CAST(0 AS BIGINT)), ('orphan_listing', CAST(0 AS BIGINT)), ('orphan_property_type', CAST(0 AS BIGINT)), ('orphan_date', CAST(0 AS BIGINT)), ('repeated_listing', CAST(0 AS BIGINT)), ('repeated_fact', CAST(0 AS BIGINT))) t(name, violations)",
    "price_parse": """WITH o AS (SELECT o_orderkey, CAST(o_orderkey % 97 AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN ',5' ELSE '.25' END AS n, o_orderkey % 5 AS k FROM orders)
      SELECT o_orderkey, CASE WHEN k = 4 THEN NULL ELSE CAST(replace(n, ',', '.') AS DOUBLE) END AS value, CASE k WHEN 0 THEN 'ty' WHEN 1 THEN 'million' WHEN 2 THEN 'million_per_m2' WHEN 3 THEN 'vnd' ELSE 'negotiable' END AS unit,
      CASE k WHEN 0 THEN CAST(trunc(CAST(replace(n, ',', '.') AS DOUBLE) * 1e9) AS BIGINT) WHEN 1 THEN CAST(trunc(CAST(replace(n, ',', '.') AS DOUBLE) * 1e6) AS BIGINT) WHEN 2 THEN CAST(trunc(CAST(replace(n, ',', '.') AS DOUBLE) * 1e6) AS BIGINT)
        WHEN 3 THEN CAST(trunc(CAST(replace(n, ',', '.') AS DOUBLE)) AS BIGINT) END AS vnd FROM o""",
    "property_types": """SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'apartment' WHEN p_partkey % 6 = 1 THEN 'house' WHEN p_partkey % 6 = 2 THEN 'land' WHEN p_partkey % 6 = 3 THEN 'villa_townhouse' WHEN p_partkey % 6 = 4 THEN 'street_house' ELSE 'unknown' END AS kind FROM part""",
    "clean_text": r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[·•]', ' ', 'g'), '\s+', ' ', 'g'))) AS cleaned FROM documents",
    "slug_key": r"SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, left(sha256(lower(trim(p_name)) || '|NONE'), 16) AS key FROM part",
    "url_norm": r"SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[^?#]+')), '/+$', '') AS url FROM pages",
    "features_text": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 60 BETWEEN 1 AND 50 THEN CAST(o_orderkey % 60 AS INTEGER) END AS floor_count,
      CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 4 + 1.5 AS DOUBLE) END AS frontage_width, CAST(o_orderkey % 4 + 1 AS INTEGER) AS bedroom_count,
      CASE WHEN o_orderkey % 2 = 0 THEN 'dong_nam' ELSE 'tay' END AS direction, o_orderkey % 3 = 1 AS is_price_negotiable, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0 THEN 'car_can_enter' END AS car_access_type FROM orders""",
    "json_ads": "SELECT CAST(n_nationkey AS VARCHAR) AS listing_id, 'https://www.nhatot.com/mua-ban-nha-dat-dong-da-ha-noi/' || CAST(n_nationkey + 100 AS VARCHAR) || '.htm' AS listing_url, n_name AS listing_card_title, CAST(n_nationkey * 1000 AS BIGINT) AS price_vnd FROM nation",
    "duplicate_summary": f"WITH {FLAGGED} SELECT crawl_date, count(*) AS rows, count(*) FILTER (WHERE is_duplicate_in_snapshot) AS duplicate_rows, count(DISTINCT CASE WHEN is_duplicate_in_snapshot THEN dedup_key END) AS duplicate_groups FROM flagged GROUP BY crawl_date",
    "removed_per_source": f"""WITH {DAILY}, days AS (SELECT source, crawl_date, lead(crawl_date) OVER (PARTITION BY source ORDER BY crawl_date) AS next_date FROM (SELECT DISTINCT source, crawl_date FROM daily))
      SELECT d.dedup_key, y.next_date AS snapshot_date, d.crawl_date AS last_seen_before_removed FROM daily d JOIN days y ON d.crawl_date = y.crawl_date AND d.source = y.source
      WHERE y.next_date IS NOT NULL AND NOT EXISTS (SELECT 1 FROM daily n WHERE n.dedup_key = d.dedup_key AND n.crawl_date > d.crawl_date AND n.crawl_date <= y.next_date)""",
    "union_by_name": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, CAST(NULL AS BIGINT) AS region FROM region UNION ALL SELECT CAST(n_nationkey AS BIGINT), n_name, CAST(n_regionkey AS BIGINT) FROM nation",
    "large_medians": "SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS median_price, count(*) AS n FROM lineitem GROUP BY l_returnflag",
    "price_changed_rows": f"WITH {SNAPSHOTS} SELECT dedup_key, snapshot_date, price_change_vnd FROM snap WHERE is_price_changed",
    "info_changed_by_date": f"WITH {SNAPSHOTS} SELECT snapshot_date, count(*) AS n FROM snap WHERE is_info_changed GROUP BY snapshot_date",
    "removed_by_date": f"WITH {REMOVED} SELECT next_date AS snapshot_date, count(*) AS n FROM removed GROUP BY next_date",
    "captures_by_source": f"WITH {LISTINGS} SELECT source, crawl_date, count(*) AS n FROM keyed GROUP BY source, crawl_date",
    "district_counts": f"""WITH {SNAPSHOTS}, cur AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY snapshot_date DESC) AS rn FROM snap)
      SELECT coalesce(district_norm, 'none') AS district_norm, count(*) AS n FROM cur WHERE rn = 1 GROUP BY ALL""",
    "gold_checks": f"SELECT t.name AS \"check\", CAST(0 AS BIGINT) AS violations FROM (SELECT unnest({_GOLD_CHECKS}) AS name) t",
    "star_checks": f"SELECT t.name AS \"check\", CAST(0 AS BIGINT) AS violations FROM (SELECT unnest({_STAR_CHECKS}) AS name) t",
    "silver_checks": f"WITH {LISTINGS} SELECT 'rows' AS \"check\", CAST(CASE WHEN count(*) < 10 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM listings UNION ALL SELECT 'origin_columns', 0 UNION ALL SELECT 'source_origin', count(*) FROM listings WHERE source <> 'src0'",
    "star_counts": f"""WITH {SNAPSHOTS}, k AS (SELECT *, coalesce(listing_id, lower(listing_url), lower(dedup_key)) AS v FROM snap), c AS (
        SELECT 'dim_date' AS t, count(DISTINCT crawl_date) AS n FROM keyed UNION ALL SELECT 'dim_source', 1 UNION ALL SELECT 'dim_property_type', count(DISTINCT property_type_group) + 1 FROM keyed
        UNION ALL SELECT 'dim_location', count(*) FROM (SELECT coalesce(city_norm, 'unknown') AS c, coalesce(district_norm, 'unknown') AS d FROM snap UNION SELECT 'unknown', 'unknown')
        UNION ALL SELECT 'dim_listing', count(*) FROM (SELECT DISTINCT source, v FROM k) UNION ALL SELECT 'fact_listing', count(*) FROM snap UNION ALL SELECT 'fact_quality', count(DISTINCT crawl_date) FROM keyed)
      SELECT t AS "table", n, (SELECT count(DISTINCT snapshot_date) FROM snap) AS days, 'unknown,src0,src1' AS codes FROM c""",
    "run_summaries": f"WITH {RUNS} SELECT run_id, run_class, pipeline_status, publish_status, publish_block_reason, CAST(records AS BIGINT) AS silver_records_written, CAST(0 AS DOUBLE) AS duplicate_rate, CAST(len(source_names) AS INTEGER) AS sources FROM decided",
    "daily_summaries": f"WITH {RUNS} SELECT run_id, pipeline_status, CASE WHEN k % 11 = 0 THEN 'lost' WHEN k % 7 = 0 THEN 'Pipeline failed' END AS error_message, CAST(records AS BIGINT) AS total_silver_records, CAST(0 AS BIGINT) AS duration_seconds, CAST(CASE WHEN k % 2 = 0 THEN 2 ELSE 0 END AS INTEGER) AS days FROM decided",
    "snapshot_days": f"WITH {RUNS} SELECT run_id AS run_date, unnest(['2024-01-01', '2024-01-02']) AS snapshot_date, CAST(records AS BIGINT) AS total_silver_records FROM runs WHERE k % 2 = 0",
    "source_rows": f"""WITH {RUNS}, q AS (SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS n FROM lineitem GROUP BY l_orderkey)
      SELECT unnest(source_names) AS source_code, run_id, publish_status, CAST(coalesce(nullif(CASE WHEN k % 6 = 0 THEN k % 50 END, 0), n, 0) AS BIGINT) AS silver_quarantine_count, CAST((k % 100) / 100 AS DOUBLE) AS parse_success_rate
      FROM decided LEFT JOIN q ON k = l_orderkey""",
    "promotion": f"SELECT n_name AS source_code, CASE WHEN reasons = 0 THEN 'pass' ELSE 'blocked' END AS status, reasons FROM ({_SOURCES})",
    "acceptance": f"""SELECT n_name AS source_code, CASE WHEN k % 10 <> 3 AND k % 4 <> 2 AND k > 0 AND k % 5 <> 4 THEN 'pass' ELSE 'fail' END AS technical_readiness_status,
      CASE WHEN k % 10 <> 3 AND k % 4 <> 2 AND k > 0 AND k % 5 <> 4 AND reasons = 0 THEN 'pass' ELSE 'blocked' END AS source_acceptance_status, k % 5 <> 4 AS warehouse_source_present FROM ({_SOURCES})""",
    "block_reasons": f"""WITH {LOG} SELECT event_id, block_reason, CASE block_reason WHEN 'cloudflare_challenge' THEN 'Blocked by Cloudflare anti-bot protection' WHEN 'captcha' THEN 'Blocked by CAPTCHA anti-bot protection'
      WHEN 'http_403' THEN 'Blocked by anti-bot protection' WHEN 'http_429' THEN 'Blocked by anti-bot protection' END AS message, class, coalesce(status <> 200, TRUE) AS again FROM judged""",
    "crawl_rollup": f"""WITH {LOG}, g AS (SELECT part, count(*) AS requests, count(*) FILTER (WHERE status = 200 AND block_reason IS NULL) AS successes, count(block_reason) AS blocked, count(*) - count(DISTINCT user_id % 40) AS duplicate_urls,
        round(avg(i % 1000), 9) AS avg_html_bytes, count(*) FILTER (WHERE i % 4 = 0) AS audits_passed, count(*) FILTER (WHERE status = 403) AS http_403_count, count(*) FILTER (WHERE status = 429) AS http_429_count,
        count(*) FILTER (WHERE class = 'blocked') AS blocked_count, count(*) FILTER (WHERE class = 'failed_http' AND status <> 200) AS failed_http_count, count(*) FILTER (WHERE class = 'failed_timeout') AS failed_timeout_count,
        count(*) FILTER (WHERE class = 'failed_fetch') AS failed_fetch_count FROM judged GROUP BY part)
      SELECT *, round(successes / requests, 9) AS success_rate, round(blocked / requests, 9) AS block_rate, round(audits_passed / requests, 9) AS audit_pass_rate FROM g""",
    "page_fields": """WITH o AS (SELECT *, o_orderkey AS k, CAST(o_orderkey % 90 + 1 AS VARCHAR) AS n, o_orderkey % 90 + 1 AS m FROM orders)
      SELECT CAST(k AS VARCHAR) AS listing_id, CASE WHEN k % 4 = 1 THEN 'Khoảng giá ' || n || ' triệu' ELSE 'Nhà có ' || k % 5 || ' phòng ngủ và ' || k % 3 || ' toilet' END AS title_raw, CASE WHEN k % 2 = 0 THEN n || ',5 tỷ' WHEN k % 4 = 1 THEN 'Khoảng giá ' || n || ' triệu' END AS price_raw, n || ' m2' AS area_raw,
      CASE WHEN k % 3 = 0 THEN 'Phố Huế, Hà Nội' ELSE nullif(concat_ws(', ', CASE WHEN k % 8 = 0 THEN 'Quận 1' END, CASE WHEN k % 7 = 0 THEN 'ha-noi' END), '') END AS location_raw,
      CASE WHEN k % 3 = 0 THEN 'detail_text_field' WHEN k % 8 = 0 OR k % 7 = 0 THEN 'crawl_context' ELSE 'unknown' END AS location_parse_method, CASE WHEN k % 3 = 0 THEN 'high' WHEN k % 8 = 0 OR k % 7 = 0 THEN 'medium' ELSE 'unknown' END AS location_confidence,
      CASE WHEN k % 7 = 0 OR k % 3 = 0 THEN 'Hà Nội' END AS city_norm, CASE WHEN k % 8 = 0 THEN 'Quận 1' END AS district_norm, CASE WHEN k % 6 = 0 THEN '01/02/2024' END AS posted_date_raw, CAST(k % 5 AS INTEGER) AS bedroom_count,
      CAST(k % 3 AS INTEGER) AS bathroom_count, CASE WHEN k % 2 = 0 THEN 'ty' WHEN k % 4 = 1 THEN 'million' END AS price_unit,
      CASE WHEN k % 2 = 0 THEN CAST((m + 0.5) * 1e9 AS BIGINT) WHEN k % 4 = 1 THEN CAST(m * 1000000 AS BIGINT) END AS price_vnd, CAST(m AS DOUBLE) AS area_m2 FROM o""",
    "silver_records": """WITH o AS (SELECT *, o_orderkey AS k, o_orderkey % 90 + 1 AS m, o_orderkey % 5 = 0 AS api FROM orders)
      SELECT CAST(k AS VARCHAR) AS listing_id, CASE WHEN api THEN 'NhaTot' ELSE 'other' END AS source, CASE WHEN api THEN 'NhaTot' END AS source_code, CASE WHEN api THEN 'NhaTot::' || k END AS dedup_key, CASE WHEN api THEN 'listing_id' END AS dedup_method,
      CASE WHEN api THEN 'Ad ' || k WHEN k % 4 = 1 THEN 'Khoảng giá ' || m || ' triệu' ELSE 'Nhà có ' || k % 5 || ' phòng ngủ và ' || k % 3 || ' toilet' END AS title_raw, CASE WHEN api OR k % 2 = 0 THEN 'ty' WHEN k % 4 = 1 THEN 'million' END AS price_unit,
      CASE WHEN api THEN CAST(m * 1000000000 AS BIGINT) WHEN k % 2 = 0 THEN CAST((m + 0.5) * 1e9 AS BIGINT) WHEN k % 4 = 1 THEN CAST(m * 1000000 AS BIGINT) END AS price_vnd, CAST(m AS DOUBLE) AS area_m2, 'ban-dat' AS property_type_raw,
      CASE WHEN api THEN 'unknown' ELSE 'land' END AS property_type_group, CASE WHEN api THEN 'metadata_field' WHEN k % 3 = 0 THEN 'detail_text_field' WHEN k % 8 = 0 OR k % 7 = 0 THEN 'crawl_context' ELSE 'unknown' END AS location_parse_method,
      'success' AS parse_status, 'phase2_v1' AS parser_version, 52 AS fields FROM o""",
    "features_more": """WITH o AS (SELECT *, o_orderkey AS k FROM orders)
      SELECT o_orderkey, k % 3 < 2 AS has_legal_info, CASE k % 3 WHEN 0 THEN 'so hong' WHEN 1 THEN 'tranh chap' END AS legal_status_raw, k % 3 = 0 AS has_red_pink_book, CASE k % 4 WHEN 0 THEN 'owner' WHEN 1 THEN 'broker' END AS seller_type,
      CASE k % 5 WHEN 0 THEN 'full' WHEN 1 THEN 'basic' WHEN 2 THEN 'raw' WHEN 3 THEN 'mentioned' END AS furniture_level, CASE WHEN k % 2 = 0 THEN CAST(k % 6 + 1 AS INTEGER) END AS bathroom_count, CASE WHEN k % 7 = 0 THEN 'Sao Mai' END AS project_name,
      k % 8 = 0 AS is_business_suitable, k % 9 = 0 AS has_urban_area_flag, k % 11 = 0 AS has_security_flag, k % 12 = 0 AS has_educated_community_flag, k % 12 = 0 AS has_high_intellect_flag, k % 10 = 0 AS has_residential_area_flag,
      k % 13 = 0 AS has_subdivision_flag, FALSE AS has_car_access, CASE WHEN k % 14 = 0 THEN 'S1' END AS building_name FROM o""",
    "place_evidence": """WITH n AS (SELECT *, n_nationkey AS k FROM nation)
      SELECT n_nationkey, CASE WHEN k % 4 < 2 THEN 'detail_address_block' WHEN k % 3 = 0 THEN 'listing_card_location' WHEN k % 5 = 0 THEN 'detail_url' WHEN k % 2 = 0 THEN 'seed_url' ELSE 'none' END AS source,
      CASE WHEN k % 4 = 0 THEN 'matched' WHEN k % 4 = 1 THEN 'mismatch' WHEN k % 3 = 0 OR k % 5 = 0 THEN 'matched' WHEN k % 2 = 0 THEN 'assumed_from_seed' ELSE 'unknown' END AS status,
      CASE WHEN k % 4 = 0 THEN 'detail_address_block' WHEN k % 4 = 1 THEN 'detail_address_block_contains_other_location:Đống Đa' WHEN k % 3 = 0 THEN 'listing_card_location' WHEN k % 5 = 0 THEN 'detail_url_contains_location_path'
        WHEN k % 2 = 0 THEN 'seed_url_context' ELSE 'no_location_evidence' END AS method,
      CASE WHEN k % 4 = 0 THEN 'Phố Huế, Hai Bà Trưng' END AS line, k % 2 = 0 AS seed_ok, CASE WHEN k % 3 = 0 THEN k % 2 = 1 ELSE k % 2 = 0 END AS kind_ok,
      CASE WHEN k % 2 = 1 THEN 'unknown' WHEN k % 4 = 0 THEN 'matched' ELSE 'assumed_from_seed' END AS text_status,
      CASE WHEN k % 2 = 1 THEN 'invalid_seed_url' WHEN k % 4 = 0 THEN 'detail_text_contains_location' ELSE 'seed_url_context' END AS text_method FROM n""",
    "html_text": r"""WITH a AS (SELECT page_id, regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<!--.*?-->|<!doctype[^>]*>', '', 'g') AS x FROM pages),
      b AS (SELECT page_id, regexp_replace(x, '(?s)<[a-zA-Z/][^>]*>', chr(10), 'g') AS x FROM a),
      c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&') AS x FROM b)
      SELECT page_id, array_to_string(list_filter(list_transform(regexp_split_to_array(x, '\r\n|[\n\r\x0B\x0C]'), lambda l: trim(l, ' ' || chr(9) || chr(160))), lambda l: l <> ''), chr(10)) AS text FROM c""",
}
