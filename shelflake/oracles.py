"""The registered queries in DuckDB's SQL, written independently of the Spark code."""

from __future__ import annotations

_FEED = r"""
WITH keyed AS (
    SELECT *, p_partkey AS k, unnest([1, 2, 3]) AS s,
           CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS money
    FROM part
),
feed AS (
    SELECT
        lower(p_type) AS category,
        CAST(s AS INTEGER) AS snap,
        k,
        CASE WHEN k % 97 = 0 THEN 'n/a'
             ELSE CAST(1 + (k * 7919 + s * 104729) % 100003 AS VARCHAR) END AS rank,
        printf('B%09d', k) AS asin,
        CASE k % 5
            WHEN 0 THEN p_name || ', ' || p_brand || ' | ' || p_type
            WHEN 1 THEN p_name || ' | ' || p_brand
            WHEN 2 THEN p_name
            WHEN 3 THEN p_name || '|' || p_brand || ', ' || p_type
        END AS product_title,
        CASE k % 9
            WHEN 0 THEN '$' || money
            WHEN 1 THEN '$1,' || money
            WHEN 2 THEN '€' || money
            WHEN 3 THEN '£' || money
            WHEN 4 THEN 'None'
            WHEN 6 THEN '€1.' || CAST(p_size AS VARCHAR) || ',99'
            WHEN 7 THEN '$12.99 - $' || money
            WHEN 8 THEN '$123456789.00'
        END AS product_price,
        CASE WHEN k % 89 = 0 THEN 'bad' WHEN k % 83 = 0 THEN 'NaN'
             ELSE CAST((p_size % 50) // 10 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR)
        END AS product_star_rating,
        CASE WHEN k % 79 = 0 THEN '1,234' WHEN k % 73 = 0 THEN '1e3'
             ELSE CAST((k * 31 + s) % 5000 AS VARCHAR) END AS product_num_ratings,
        'https://example.com/dp/' || CAST(k AS VARCHAR) AS product_url,
        'https://example.com/img/' || CAST(k AS VARCHAR) || '.jpg' AS product_photo,
        CAST(NULL AS VARCHAR) AS rank_change_label,
        TIMESTAMP '2024-01-01 12:00:00' + to_days(CAST(s - 1 AS INTEGER)) AS fetch_timestamp
    FROM keyed
)"""

_FIELDS = """rank, asin, product_title, product_price, product_star_rating,
    product_num_ratings, product_url, product_photo, rank_change_label"""


def _double(text: str) -> str:
    number = f"TRY_CAST({text} AS DOUBLE)"
    return f"CASE WHEN NOT isnan({number}) THEN {number} END"


def _long(text: str) -> str:
    number = f"TRY_CAST({text} AS DOUBLE)"
    return (
        rf"CASE WHEN regexp_full_match({text}, '\s*[+-]?[0-9]+\s*') THEN TRY_CAST({text} AS BIGINT) "
        f"WHEN {number} = floor({number}) THEN TRY_CAST({number} AS BIGINT) END"
    )


def _typed(source: str, price: str = "product_price", stamp: str = "fetch_timestamp") -> str:
    return f"""
typed AS (
    SELECT {_long("rank")} AS rank, asin, product_title, {price} AS product_price,
           {_double("product_star_rating")} AS product_star_rating,
           {_long("product_num_ratings")} AS product_num_ratings,
           product_url, product_photo, rank_change_label, {stamp} AS fetch_timestamp,
           category, snap
    FROM {source}
)"""


_LAKE_COLUMNS = """rank, asin, product_title, product_price, product_star_rating,
    product_num_ratings, product_url, product_photo, rank_change_label, fetch_timestamp, category"""

_KEYS = """strftime(fetch_timestamp, '%Y') AS year, strftime(fetch_timestamp, '%m') AS month,
    strftime(fetch_timestamp, '%d') AS day"""

_FILE_KEY = "'amazonbestsellers_' || category || '_' || strftime(fetch_timestamp, '%Y%m%d')"

_CURRENCY = """CASE WHEN contains(product_price, '$') THEN 'USD'
    WHEN contains(product_price, '€') THEN 'EUR'
    WHEN contains(product_price, '£') THEN 'GBP' ELSE 'Unknown' END"""

_SHORT_TITLE = """CASE WHEN split_part(product_title, ',', 1) = product_title
    THEN split_part(product_title, '|', 1) ELSE split_part(product_title, ',', 1) END"""

# Everything but digits and dots is dropped, then all pieces but the last are joined.
_PIECES = "string_split(regexp_replace(product_price, '[^0-9.]', '', 'g'), '.')"
_CLEANED = f"""CASE WHEN len({_PIECES}) > 1
    THEN array_to_string(list_slice({_PIECES}, 1, len({_PIECES}) - 1), '') || '.' || {_PIECES}[-1]
    ELSE regexp_replace(product_price, '[^0-9.]', '', 'g') END"""


def _warehouse(source: str = "typed") -> str:
    return f"""
warehouse AS (
    SELECT TRY_CAST(product_num_ratings AS INTEGER) AS product_num_ratings,
           TRY_CAST(rank AS INTEGER) AS rank, product_star_rating, category,
           product_photo, product_url, {_CURRENCY} AS currency,
           {_SHORT_TITLE} AS short_product_title, product_title, asin, fetch_timestamp,
           TRY_CAST({_CLEANED} AS DECIMAL(10,2)) AS product_price, snap
    FROM {source}
)"""


_WAREHOUSE_COLUMNS = """product_num_ratings, rank, product_star_rating, category, product_photo,
    product_url, currency, short_product_title, product_title, asin, fetch_timestamp, product_price"""

_DAY = "strftime(fetch_timestamp, '%Y%m%d') AS snapshot_day"

_FLAWED = """
flawed AS (
    SELECT * REPLACE (
        CASE WHEN k % 101 <> 0 THEN asin END AS asin,
        CASE WHEN k % 103 = 0 THEN repeat('long title ', 100) ELSE product_title END
            AS product_title)
    FROM feed
)"""

_VIOLATIONS = """concat_ws('; ',
    CASE WHEN asin IS NULL THEN 'asin is missing' END,
    CASE WHEN length(category) > 255 THEN 'category is longer than 255' END,
    CASE WHEN length(product_photo) > 1000 THEN 'product_photo is longer than 1000' END,
    CASE WHEN length(product_url) > 1000 THEN 'product_url is longer than 1000' END,
    CASE WHEN length(currency) > 10 THEN 'currency is longer than 10' END,
    CASE WHEN length(short_product_title) > 500 THEN 'short_product_title is longer than 500' END,
    CASE WHEN length(product_title) > 1000 THEN 'product_title is longer than 1000' END,
    CASE WHEN length(asin) > 50 THEN 'asin is longer than 50' END)"""

_NEW_YEAR = "TIMESTAMP '2023-12-31 22:00:00'"

_STATUS = """
responses AS (
    SELECT category, true AS usable, 1 AS n, 3 AS listings FROM feed WHERE snap = 1
    UNION ALL
    SELECT category, k % 5 = 3, 1, 0 FROM feed WHERE snap = 1
),
status AS (
    SELECT category, bool_or(usable) AS ok, CAST(sum(n) AS BIGINT) AS response_count,
           CAST(sum(CASE WHEN usable THEN 0 ELSE 1 END) AS BIGINT) AS failed_count,
           CAST(sum(listings) AS BIGINT) AS row_count,
           CAST(sum(listings) AS VARCHAR) || ' listings for ' || category AS message
    FROM responses GROUP BY category
)"""

_STATUS_JSON = """'{"category":"' || category || '","ok":' || CAST(ok AS VARCHAR)
    || ',"response_count":' || CAST(response_count AS VARCHAR)
    || ',"failed_count":' || CAST(failed_count AS VARCHAR)
    || ',"row_count":' || CAST(row_count AS VARCHAR)
    || ',"message":"' || message || '"}'"""

_LOCAL_TIME = f"""fetch_timestamp + to_hours(CAST(coalesce({_long("product_num_ratings")}, 0) % 24 - 5 AS INTEGER))"""

_TYPED_FEED = f"{_FEED},{_typed('feed')}"
_WAREHOUSE_FEED = f"{_TYPED_FEED},{_warehouse()}"

ORACLES: dict[str, str] = {
    "envelope_listings": f"{_FEED} SELECT category, {_FIELDS} FROM feed",
    "envelope_status": f"{_FEED},{_STATUS} SELECT *, {_STATUS_JSON} AS status FROM status",
    "ingest_status": f"""{_FEED},{_STATUS},
        asked AS (SELECT unnest(['large', 'small', 'absent']) AS category),
        answered AS (
            SELECT a.category, coalesce(ok, false) AS ok,
                   coalesce(response_count, 0) AS response_count,
                   coalesce(failed_count, 0) AS failed_count,
                   coalesce(row_count, 0) AS row_count,
                   coalesce(message, 'no usable response for ' || a.category) AS message
            FROM asked a LEFT JOIN status s ON a.category = s.category
        )
        SELECT category, {_STATUS_JSON} AS status FROM answered""",
    "ingest_lake": f"""{_FEED},{_typed("feed", stamp=_NEW_YEAR)}
        SELECT {_LAKE_COLUMNS}, '2023' AS year, '12' AS month, '31' AS day FROM typed""",
    "ingest_flat": f"""{_FEED},{_typed("feed", stamp=_NEW_YEAR)}
        SELECT {_LAKE_COLUMNS}, {_FILE_KEY} AS file_key FROM typed""",
    "coerce_numeric": f"""{_TYPED_FEED}
        SELECT asin, snap, rank, product_num_ratings, product_star_rating FROM typed""",
    "lake_typed": f"{_TYPED_FEED} SELECT {_LAKE_COLUMNS} FROM typed",
    "stamped_listings": f"""{_FEED},{_typed("feed", stamp=_NEW_YEAR)}
        SELECT {_LAKE_COLUMNS} FROM typed""",
    "partition_keys": f"""{_FEED},
        local AS (SELECT * REPLACE ({_LOCAL_TIME} AS fetch_timestamp) FROM feed)
        SELECT asin, snap, {_KEYS},
               'category=' || category || strftime(fetch_timestamp, '/year=%Y/month=%m/day=%d/')
                   AS lake_key,
               {_FILE_KEY} AS flat_key
        FROM local""",
    "lake_roundtrip_partitioned": f"{_TYPED_FEED} SELECT {_LAKE_COLUMNS}, {_KEYS} FROM typed",
    "lake_overwrite_same_day": f"""
        {_FEED},{_typed("feed", price="CASE WHEN snap = 2 THEN '$1' ELSE product_price END")}
        SELECT {_LAKE_COLUMNS}, {_KEYS} FROM typed""",
    "lake_roundtrip_flat": f"{_TYPED_FEED} SELECT {_LAKE_COLUMNS}, {_FILE_KEY} AS file_key FROM typed",
    "lake_scan_day": f"""{_TYPED_FEED}
        SELECT {_LAKE_COLUMNS}, {_KEYS} FROM typed
        WHERE CAST(fetch_timestamp AS DATE) = DATE '2024-01-02'""",
    "lake_sql_category": f"""{_TYPED_FEED}
        SELECT category, {_KEYS}, asin, rank, product_price FROM typed
        WHERE category IN ('economy', 'small')
          AND CAST(fetch_timestamp AS DATE) = DATE '2024-01-03'""",
    "lake_sql_written": f"""{_TYPED_FEED}
        SELECT category, {_KEYS}, count(*) AS n_rows FROM typed GROUP BY ALL""",
    "day_row_count": f"""{_FEED}
        SELECT count(*) AS total_rows FROM feed
        WHERE CAST(fetch_timestamp AS DATE) = DATE '2024-01-02'""",
    "derive_currency": f"{_FEED} SELECT asin, snap, product_price, {_CURRENCY} AS currency FROM feed",
    "normalize_price": f"""{_FEED}
        SELECT asin, snap, {_CLEANED} AS cleaned_price,
               TRY_CAST({_CLEANED} AS DECIMAL(10,2)) AS product_price
        FROM feed""",
    "derive_short_title": f"""{_FEED}
        SELECT asin, snap, product_title, {_SHORT_TITLE} AS short_title FROM feed""",
    "etl_warehouse_day": f"""{_WAREHOUSE_FEED}
        SELECT {_WAREHOUSE_COLUMNS} FROM warehouse
        WHERE CAST(fetch_timestamp AS DATE) = DATE '2024-01-02'""",
    "etl_warehouse_all": f"{_WAREHOUSE_FEED} SELECT {_WAREHOUSE_COLUMNS} FROM warehouse",
    "lost_values_by_day": f"""{_FEED},{_typed("(SELECT *, rank AS rank_text, product_num_ratings AS ratings_text, product_star_rating AS star_text FROM feed)").replace("category, snap", "category, snap, rank_text, ratings_text, star_text")},
        final AS (
            SELECT strftime(fetch_timestamp, '%Y%m%d') AS snapshot_day, category,
                   ratings_text IS NOT NULL AND TRY_CAST(product_num_ratings AS INTEGER) IS NULL AS a,
                   rank_text IS NOT NULL AND TRY_CAST(rank AS INTEGER) IS NULL AS b,
                   star_text IS NOT NULL AND product_star_rating IS NULL AS c,
                   product_price IS NOT NULL AND TRY_CAST({_CLEANED} AS DECIMAL(10,2)) IS NULL AS d
            FROM typed
        ),
        counted AS (
            SELECT snapshot_day, category, count(*) AS n_rows,
                   [count(*) FILTER (a), count(*) FILTER (b), count(*) FILTER (c), count(*) FILTER (d)] AS n
            FROM final GROUP BY snapshot_day, category
        )
        SELECT snapshot_day, category, n_rows, column_name, n[i] AS n_lost
        FROM counted, (VALUES (1, 'product_num_ratings'), (2, 'rank'), (3, 'product_star_rating'),
                              (4, 'product_price')) AS names(i, column_name)""",
    "constraint_rejects": f"""{_FEED},{_FLAWED},{_typed("flawed")},{_warehouse()}
        SELECT {_WAREHOUSE_COLUMNS}, {_VIOLATIONS} AS violations
        FROM warehouse WHERE {_VIOLATIONS} <> ''""",
    "warehouse_append": f"""{_WAREHOUSE_FEED}
        SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse
        UNION ALL
        SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse""",
    "warehouse_replace_day": f"""
        {_FEED},{_typed("feed", price="CASE WHEN snap = 2 THEN '£7.50' ELSE product_price END")},
        {_warehouse()}
        SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse""",
    "warehouse_identity": f"""{_FEED}
        SELECT {_DAY}, row_number() OVER (ORDER BY snap) AS unique_id FROM feed""",
    "warehouse_rejects": f"""{_FEED},{_FLAWED},{_typed("flawed")},{_warehouse()}
        SELECT {_WAREHOUSE_COLUMNS}, {_VIOLATIONS} AS violations, {_DAY}
        FROM warehouse WHERE {_VIOLATIONS} <> ''""",
    "load_counts": f"""{_FEED},{_FLAWED},{_typed("flawed")},{_warehouse()},
        checked AS (SELECT {_DAY}, {_VIOLATIONS} <> '' AS broken FROM warehouse)
        SELECT snapshot_day, count(*) AS rows_read,
               CAST(sum(CASE WHEN broken THEN 0 ELSE 1 END) AS BIGINT) AS rows_loaded,
               CAST(sum(CASE WHEN broken THEN 1 ELSE 0 END) AS BIGINT) AS rows_rejected
        FROM checked GROUP BY snapshot_day
        UNION ALL
        SELECT '20240104', 0, 0, 0""",
    "incremental_load": f"{_WAREHOUSE_FEED} SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse",
    "incremental_rewritten_day": f"""
        {_FEED},{_typed("feed", price="CASE WHEN snap = 2 THEN '£7.50' ELSE product_price END")},
        {_warehouse()}
        SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse""",
    "changed_days_load": f"""
        {_FEED},{_typed("feed", price="CASE WHEN snap = 2 THEN '£7.50' ELSE product_price END")},
        {_warehouse()}
        SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse""",
    "changed_days_counts": f"""{_FEED},{_FLAWED},{_typed("flawed")},{_warehouse()},
        checked AS (
            SELECT CAST(strftime(CAST(fetch_timestamp AS DATE), '%d') AS INTEGER) AS d, category,
                   {_VIOLATIONS} <> '' AS broken
            FROM warehouse
        ),
        runs AS (
            SELECT * FROM (VALUES (1, [1, 2]), (2, []), (3, [2, 3]), (4, [])) AS r(run, days)
        ),
        counts AS (
            SELECT run, count(DISTINCT (d, category)) FILTER (d IS NOT NULL) AS category_days, count(d) AS rows_read,
                   count(d) FILTER (NOT broken) AS rows_loaded, count(d) FILTER (broken) AS rows_rejected
            FROM runs LEFT JOIN checked ON list_contains(days, d) GROUP BY run
        )
        SELECT CAST(run AS BIGINT) AS run,
               CASE run WHEN 4 THEN (SELECT count(DISTINCT category) FROM checked WHERE d = 1)
                        ELSE category_days END AS category_days,
               rows_read, rows_loaded, rows_rejected,
               (SELECT count(*) FROM checked WHERE d > 1 AND NOT broken) AS rows_left
        FROM counts""",
    "warehouse_replace_categories": f"""
        {_FEED},
        {_typed("feed", price="CASE WHEN snap = 2 AND category IN ('large', 'small') THEN '£7.50' ELSE product_price END")},
        {_warehouse()}
        SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse""",
    "warehouse_replace_rejected": f"""{_WAREHOUSE_FEED}
        SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse
        WHERE CAST(fetch_timestamp AS DATE) <> DATE '2024-01-02'""",
    "warehouse_vanished_day": f"""{_WAREHOUSE_FEED}
        SELECT {_WAREHOUSE_COLUMNS}, {_DAY} FROM warehouse
        WHERE CAST(fetch_timestamp AS DATE) <> DATE '2024-01-02'""",
    "file_names": f"""{_FEED},
        named AS (
            SELECT asin, snap, unnest([0, 1, 2, 3]) AS form,
                   'amazonbestsellers_' || category || ' +é_' || strftime(fetch_timestamp, '%Y%m%d') AS key,
                   category || ' +é' AS found
            FROM feed
        )
        SELECT asin, snap, CAST(form AS INTEGER) AS form,
               CASE form WHEN 0 THEN 'file:/drops/' || key || '.parquet'
                         WHEN 1 THEN 'file:/drops/' || key || '.parquet/part-0.parquet'
                         WHEN 2 THEN 'file:/drops/snapshot_key=' || key || '/part-0.parquet'
                         ELSE 'file:/drops/amazonbestsellers.parquet' END AS file_path,
               CASE form WHEN 0 THEN key || '.parquet' WHEN 3 THEN 'amazonbestsellers.parquet'
                         ELSE 'part-0.parquet' END AS filename,
               CASE form WHEN 3 THEN 'amazonbestsellers' ELSE key END AS file_key,
               CASE form WHEN 3 THEN '' ELSE found END AS found
        FROM named""",
    "organize_empty_drop": f"""{_FEED},
        drops AS (SELECT count(DISTINCT {_FILE_KEY}) FILTER (snap = 1) + 1 AS n FROM feed)
        SELECT CAST(1 AS BIGINT) AS run, n AS organized, CAST(0 AS BIGINT) AS skipped,
               CAST(0 AS BIGINT) AS unmatched FROM drops
        UNION ALL SELECT 2, 0, n, 0 FROM drops""",
    "file_lineage": f"""{_FEED}
        SELECT asin, {_FILE_KEY} AS file_key, category, category || '/' || {_FILE_KEY} AS destination
        FROM feed""",
    "distinct_file_keys": f"""{_FEED}
        SELECT DISTINCT category, {_FILE_KEY} AS file_key,
               category || '/' || {_FILE_KEY} AS destination
        FROM feed""",
    "organize_batch": f"""
        {_FEED},{_typed("feed", price="CASE WHEN snap = 1 THEN '$1' ELSE product_price END")}
        SELECT {_FIELDS}, category, {_FILE_KEY} AS file_key FROM typed""",
    "organize_unmatched": f"""{_FEED},
        named AS (
            SELECT * REPLACE (CASE WHEN category = 'promo' THEN '' ELSE category END AS category)
            FROM feed
        )
        SELECT asin, product_url, {_FILE_KEY} AS file_key,
               CASE WHEN category = '' THEN 'rejects' ELSE 'organized' END AS place
        FROM named""",
    "organize_counts": f"""{_FEED},
        drops AS (
            SELECT count(DISTINCT {_FILE_KEY}) FILTER (snap < 3) AS early,
                   count(DISTINCT {_FILE_KEY}) FILTER (snap = 3) AS late
            FROM feed
        )
        SELECT CAST(1 AS BIGINT) AS run, early AS organized, CAST(0 AS BIGINT) AS skipped,
               CAST(0 AS BIGINT) AS unmatched FROM drops
        UNION ALL SELECT 2, 0, early, 0 FROM drops
        UNION ALL SELECT 3, late, early, 0 FROM drops""",
    "organize_closed_days": f"""{_FEED},
        drops AS (
            SELECT count(DISTINCT {_FILE_KEY}) FILTER (snap = 1) AS a, count(DISTINCT {_FILE_KEY}) FILTER (snap = 2) AS b,
                   count(DISTINCT {_FILE_KEY}) FILTER (snap = 3) AS c
            FROM feed
        )
        SELECT CAST(1 AS BIGINT) AS run, a + b AS organized, CAST(0 AS BIGINT) AS skipped,
               CAST(0 AS BIGINT) AS unmatched FROM drops
        UNION ALL SELECT 2, 0, b, 0 FROM drops
        UNION ALL SELECT 3, c, b, 0 FROM drops
        UNION ALL SELECT 4, 0, a + b + c, 0 FROM drops""",
    "organize_stream": f"""{_TYPED_FEED}
        SELECT {_FIELDS}, category, {_FILE_KEY} AS file_key, 'organized' AS place FROM typed
        UNION ALL
        SELECT * REPLACE ('$1' AS product_price, 'already_organized' AS place)
        FROM (SELECT {_FIELDS}, category, {_FILE_KEY} AS file_key, '' AS place
              FROM typed WHERE snap = 1)""",
}
