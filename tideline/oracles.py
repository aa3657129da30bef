"""DuckDB counterparts of the catalogue, written for checking, not for speed.

They join facts to the calendar before aggregating and rank rows the plain way, so a
match also confirms the cheaper shapes the Spark side uses.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

SPINE = """
    SELECT CAST(d AS DATE) AS date
    FROM generate_series(DATE '1995-01-01', DATE '2002-08-01', INTERVAL 1 DAY) AS g(d)
"""


def day_text(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR)"


def cents(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,2))"


def exact_sum(column: str) -> str:
    return f"CAST(SUM({cents(column)}) AS DOUBLE)"


def _number(column: str) -> str:
    return f"nullif(CAST({column} AS DOUBLE), 'nan'::DOUBLE)"


def _whole(column: str) -> str:
    return f"TRY_CAST(round_even(TRY_CAST({column} AS DOUBLE), 0) AS INTEGER)"


# --- calendars and slices

ORACLES["calendar_days"] = """
    WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders)
    SELECT CAST(CAST(u.d AS DATE) AS VARCHAR) AS date
    FROM b, unnest(generate_series(CAST(lo AS TIMESTAMP), hi + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS u(d)
"""

ORACLES["slice_grid"] = """
    WITH b AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
    days AS (
        SELECT CAST(u.d AS DATE) AS d
        FROM b, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS u(d)
    )
    SELECT event_type, CAST(d AS VARCHAR) AS slice_start, CAST(d + 1 AS VARCHAR) AS slice_end,
           strftime(d, '%m/%d/%Y') AS date_from, strftime(d + 1, '%m/%d/%Y') AS date_to
    FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN days
"""

ORACLES["slice_cap"] = """
    SELECT CAST(slice_date AS VARCHAR) AS slice_date, event_type, CAST(ts AS VARCHAR) AS ts, event_id, user_id
    FROM (
        SELECT *, CAST(ts AS DATE) AS slice_date,
               ROW_NUMBER() OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS rn
        FROM events
    )
    WHERE rn <= 5
"""

ORACLES["slice_gaps"] = """
    WITH days AS (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '2024-02-06', INTERVAL 1 DAY)) AS DATE) AS d),
    missing AS (
        SELECT u.user_id, d, d - CAST(row_number() OVER (PARTITION BY u.user_id ORDER BY d) AS INT) AS run
        FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN days
        WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND CAST(e.ts AS DATE) = d)
    )
    SELECT user_id, CAST(min(d) AS VARCHAR) AS first_missing, CAST(max(d) AS VARCHAR) AS last_missing, count(*) AS n_missing
    FROM missing GROUP BY user_id, run
"""

ORACLES["slice_backfill"] = """
    WITH days AS (
        SELECT CAST(d AS DATE) AS d
        FROM generate_series(DATE '2024-01-10', DATE '2024-01-16', INTERVAL 1 DAY) AS g(d)
    )
    SELECT CAST(d AS VARCHAR) AS slice_start, kind AS event_type, COUNT(event_id) AS n_landed
    FROM days CROSS JOIN (SELECT unnest(['click', 'purchase', 'refund']) AS kind)
    LEFT JOIN events ON CAST(ts AS DATE) = d AND event_type = kind
    GROUP BY d, kind
"""

# --- typing and mapping

ORACLES["typed_from_strings"] = f"""
    WITH stored AS (
        SELECT CAST(l_orderkey AS VARCHAR) || '.0' AS order_text,
               CAST(l_linenumber AS VARCHAR) AS line_text,
               CASE WHEN l_linenumber = 7 THEN 'nan' ELSE CAST({cents('l_quantity')} AS VARCHAR) END AS quantity_text,
               CASE WHEN l_linenumber = 7 THEN 'nan' ELSE CAST({cents('l_extendedprice')} AS VARCHAR) END AS price_text,
               l_quantity / 4 AS quarter,
               l_linenumber, l_returnflag, l_shipdate
        FROM lineitem
    )
    SELECT {_whole('order_text')} AS order_key,
           {_whole('line_text')} AS line_number,
           {_number('quantity_text')} AS quantity, {_number('price_text')} AS price,
           CASE WHEN l_linenumber <> 7
                THEN TRY_CAST(CAST(CAST({cents('quarter')} AS VARCHAR) AS DOUBLE) AS INTEGER) END AS quarter_quantity,
           l_linenumber <> 7 AS has_quantity,
           COALESCE(CAST(quantity_text AS DOUBLE) > 0, FALSE) AS has_quantity_literal,
           CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
           CAST(l_shipdate AS VARCHAR) AS shipped_at,
           CAST(NULL AS VARCHAR) AS not_a_time
    FROM stored
"""

ORACLES["column_mapping"] = f"""
    SELECT CAST(o_orderkey AS BIGINT) AS order_key, o_orderstatus AS status, o_totalprice AS total,
           o_orderpriority AS priority, {day_text('o_orderdate')} AS order_day,
           CAST(year(o_orderdate) AS INTEGER) AS order_year
    FROM orders
"""

ORACLES["dedup_first"] = """
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_partkey, l_suppkey,
           l_extendedprice, l_quantity
    FROM lineitem
    QUALIFY ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY lineitem.l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1
"""

ORACLES["code_filter"] = """
    SELECT p_partkey, p_brand, p_name FROM part WHERE substr(p_brand, 1, 7) = 'Brand#1'
"""

ORACLES["rule_category"] = """
    SELECT p_partkey,
           CASE WHEN p_type IN ('PROMO', 'ECONOMY') OR substr(p_name, 1, 3) IN ('red', 'hot') THEN 'Discounted'
                WHEN substr(p_name, 1, 1) = 'sm' THEN 'Unreachable'
                WHEN p_type = 'SMALL' OR p_brand IN ('Brand#1', 'Brand#2') THEN 'Small'
                WHEN substr(p_name, 1, 4) = 'blue' THEN 'Blue'
                ELSE p_type END AS category,
           CASE WHEN p_type NOT IN ('PROMO', 'ECONOMY') THEN p_size END AS regular_size
    FROM part
"""

ORACLES["parquet_glob"] = "SELECT p_type, COUNT(*) AS n FROM part GROUP BY p_type"

ORACLES["csv_line_breaks"] = """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, source || chr(10) || chr(10) || '"' || text || '",' || chr(10) AS body
    FROM documents
"""

ORACLES["sql_text"] = """
    SELECT r_name, COUNT(*) AS n_customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name
"""

ORACLES["stored_as_text"] = f"""
    SELECT l_returnflag, COUNT(*) AS n, COUNT(*) FILTER (WHERE l_linenumber = 7) AS n_marked,
           CAST(SUM({cents('l_extendedprice')}) FILTER (WHERE l_linenumber <> 7) AS DOUBLE) AS total
    FROM lineitem GROUP BY l_returnflag
"""

# --- lifecycle facts

LIFE = f"""
    SELECT o.*, s.first_ship, s.last_ship, s.quantity
    FROM orders o LEFT JOIN (
        SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship,
               {exact_sum('l_quantity')} AS quantity
        FROM lineitem GROUP BY l_orderkey
    ) s ON s.l_orderkey = o.o_orderkey
"""

ORACLES["last_status"] = f"""
    SELECT o_orderkey, CAST(greatest(o_orderdate, first_ship, last_ship) AS VARCHAR) AS last_status_at
    FROM ({LIFE})
"""

ORACLES["lifecycle_days"] = f"""
    SELECT o_orderkey, CAST(datediff('day', o_orderdate, first_ship) AS BIGINT) AS days_to_first,
           CAST(datediff('day', first_ship, last_ship) AS BIGINT) AS days_to_last
    FROM ({LIFE})
"""

ORACLES["guarded_ratio"] = """
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate,
           l_extendedprice / NULLIF(CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_quantity END, 0) AS price_per_unit
    FROM lineitem
"""

# --- rollups

ORACLES["daily_rollup"] = f"""
    SELECT CAST(s.date AS VARCHAR) AS date, {exact_sum('l_quantity')} AS sum_qty,
           COALESCE(CAST(SUM(CASE WHEN l_returnflag = 'R' THEN {cents('l_quantity')} END) AS DOUBLE), 0) AS sum_returned,
           COUNT(l_orderkey) AS n_lines,
           COUNT(CASE WHEN l_quantity > 40 THEN l_orderkey END) AS n_large,
           AVG(l_quantity) AS avg_qty
    FROM ({SPINE}) s LEFT JOIN lineitem ON s.date = CAST(l_shipdate AS DATE)
    GROUP BY s.date
"""

ORACLES["lifecycle_by_date"] = f"""
    WITH spine AS ({SPINE}), life AS ({LIFE}),
    f AS (
        SELECT s.date, COUNT(o_orderkey) AS n_first, SUM(quantity) AS qty_first,
               COALESCE(CAST(SUM(datediff('day', o_orderdate, first_ship)) AS BIGINT), 0) AS sum_days,
               AVG(datediff('day', o_orderdate, first_ship)) AS avg_days
        FROM spine s LEFT JOIN life ON s.date = CAST(first_ship AS DATE) GROUP BY 1
    ),
    p AS (
        SELECT s.date, COUNT(o_orderkey) AS n_placed, COALESCE(SUM(quantity), 0) AS qty_placed,
               SUM(quantity) FILTER (WHERE s.date < COALESCE(CAST(first_ship AS DATE), DATE '2001-08-01')
                                       AND o_orderstatus <> 'F') AS qty_waiting
        FROM spine s LEFT JOIN life ON s.date = CAST(o_orderdate AS DATE) GROUP BY 1
    ),
    e AS (
        SELECT s.date, COUNT(o_orderkey) AS n_last, COALESCE(SUM(quantity), 0) AS qty_last
        FROM spine s LEFT JOIN life ON s.date = CAST(last_ship AS DATE) GROUP BY 1
    )
    SELECT CAST(f.date AS VARCHAR) AS date, n_first, qty_first, sum_days, avg_days, n_placed, qty_placed, qty_waiting,
           n_last, qty_last, sum_days / NULLIF(qty_first, 0) AS days_per_qty
    FROM f JOIN p USING (date) JOIN e USING (date)
"""

ORACLES["chained_daily_joins"] = """
    WITH spine AS (
        SELECT CAST(u.d AS DATE) AS date
        FROM (SELECT MAX(CAST(ts AS DATE)) AS hi FROM events),
             unnest(generate_series(TIMESTAMP '1995-01-01', CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS u(d)
    )
    SELECT CAST(s.date AS VARCHAR) AS date, n_orders, n_lines, n_events
    FROM spine s
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n_orders FROM orders GROUP BY 1) a ON a.d = s.date
    LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS d, COUNT(*) AS n_lines FROM lineitem GROUP BY 1) b ON b.d = s.date
    LEFT JOIN (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n_events FROM events GROUP BY 1) c ON c.d = s.date
"""

COMBINE = f"""
    WITH spine AS ({SPINE}),
    lines AS (
        SELECT CAST(l_shipdate AS DATE) AS shipped, CAST(o_orderdate AS DATE) AS ordered, p_type, l_quantity, l_orderkey
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
        WHERE l_quantity > 10
    ),
    a AS (
        SELECT s.date, p_type, {exact_sum('l_quantity')} AS qty_shipped, COUNT(l_orderkey) AS n_shipped
        FROM spine s LEFT JOIN lines ON shipped = s.date GROUP BY 1, 2
    ),
    b AS (
        SELECT s.date, p_type, COALESCE({exact_sum('l_quantity')}, 0) AS qty_ordered, COUNT(l_orderkey) AS n_ordered
        FROM spine s LEFT JOIN lines ON ordered = s.date GROUP BY 1, 2
    )
"""

for _name, _date in {"daily_by_category": "a.date", "daily_by_category_coalesced": "COALESCE(a.date, b.date)"}.items():
    ORACLES[_name] = f"""{COMBINE}
    SELECT CAST({_date} AS VARCHAR) AS date, COALESCE(a.p_type, b.p_type) AS p_type,
           qty_shipped, n_shipped, qty_ordered, n_ordered
    FROM a FULL JOIN b ON a.date = b.date AND a.p_type = b.p_type
    """

DENSE = f"""
    WITH days AS (
        SELECT date FROM ({SPINE}) WHERE date > DATE '1996-01-01'
    ),
    facts AS (
        SELECT CAST(l_shipdate AS DATE) AS date, p_type, {exact_sum('l_quantity')} AS qty
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2
    ),
    dense AS (
        SELECT d.date, t.p_type, f.qty
        FROM days d CROSS JOIN (SELECT DISTINCT p_type FROM facts) t
        LEFT JOIN facts f ON f.date = d.date AND f.p_type = t.p_type
    )
"""

ORACLES["dense_grid"] = f"{DENSE} SELECT CAST(date AS VARCHAR) AS date, p_type, qty FROM dense"

# --- trailing windows

ORACLES["rolling_by_category"] = f"""{DENSE},
    w AS (
        SELECT date, p_type, AVG(COALESCE(qty, 0)) OVER (
            PARTITION BY p_type ORDER BY date DESC ROWS BETWEEN CURRENT ROW AND 365 FOLLOWING) AS value
        FROM dense
    )
    SELECT CAST(date AS VARCHAR) AS date, p_type, value FROM w WHERE date > DATE '1997-01-01' ORDER BY p_type, w.date
"""

ORACLES["rolling_events"] = """
    SELECT event_id, CAST(ts AS VARCHAR) AS ts, event_type, user_id,
           avg(user_id) OVER o AS avg_user, max(user_id) OVER o AS max_user, count(*) OVER o AS n_events,
           avg(user_id) OVER t AS avg_user_of_type, max(user_id) OVER t AS max_user_of_type, count(*) OVER t AS n_events_of_type
    FROM events
    WINDOW o AS (ORDER BY ts, event_id ROWS BETWEEN 365 PRECEDING AND CURRENT ROW),
           t AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)
"""

ORACLES["rolling_timeseries"] = f"""
    WITH d AS (
        SELECT s.date, {exact_sum('l_quantity')} AS qty, COUNT(l_orderkey) AS n_lines
        FROM ({SPINE}) s LEFT JOIN lineitem ON s.date = CAST(l_shipdate AS DATE)
        WHERE s.date > DATE '1996-01-01' GROUP BY 1
    ),
    w AS (
        SELECT date, AVG(qty) OVER recent AS avg_qty, AVG(n_lines) OVER recent AS avg_lines,
               CAST(SUM(n_lines) OVER recent AS BIGINT) AS sum_lines
        FROM d WINDOW recent AS (ORDER BY date DESC ROWS BETWEEN CURRENT ROW AND 365 FOLLOWING)
    )
    SELECT CAST(date AS VARCHAR) AS date, avg_qty, avg_lines, sum_lines
    FROM w WHERE date > DATE '1997-01-01' ORDER BY w.date
"""

# --- reports

ORACLES["recent_window"] = f"""
    SELECT l_orderkey, l_linenumber, {day_text('l_shipdate')} AS shipped, l_extendedprice, l_quantity
    FROM lineitem
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2001-08-01' - 7 AND DATE '2001-08-01' AND l_extendedprice > 0
    ORDER BY shipped DESC, CAST(l_extendedprice AS INTEGER) DESC, l_orderkey, l_linenumber
"""

ORACLES["top_groups"] = f"""
    SELECT n_name, CAST(COUNT(*) AS BIGINT) AS n_orders, {exact_sum('o_totalprice')} / COUNT(*) AS avg_total
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    GROUP BY n_name ORDER BY n_orders DESC, n_name LIMIT 20
"""

ORACLES["median_by_group"] = """
    SELECT o_orderpriority, COUNT(*) AS n_orders, round(MEDIAN(o_totalprice), 4) AS median_total,
           MEDIAN(CAST(datediff('day', DATE '1995-01-01', o_orderdate) AS DOUBLE)) AS median_day
    FROM orders GROUP BY o_orderpriority ORDER BY median_total DESC
"""

ORACLES["count_by_group"] = """
    SELECT event_type, COUNT(*) AS n FROM events
    WHERE CASE WHEN json_extract_string(props, '$.k') = '7' THEN 'nan' ELSE props END <> 'nan'
    GROUP BY event_type ORDER BY n DESC, event_type
"""

# --- merge and write strategies

_DATE_OF = """CASE WHEN event_type = '{kind}' AND CAST(json_extract_string(props, '$.k') AS INTEGER) <= 90
              THEN CAST(ts AS DATE) END AS {name}"""
STAGED = f"""
    SELECT *, {_DATE_OF.format(kind='view', name='viewed_at')},
           {_DATE_OF.format(kind='click', name='clicked_at')},
           {_DATE_OF.format(kind='purchase', name='bought_at')}
    FROM events
"""

ORACLES["latest_non_null"] = f"""
    WITH s AS ({STAGED}),
    last_row AS (SELECT * FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    m AS (
        SELECT user_id,
               arg_max(viewed_at, ts) FILTER (WHERE viewed_at IS NOT NULL) AS viewed_at,
               arg_max(clicked_at, ts) FILTER (WHERE clicked_at IS NOT NULL) AS clicked_at,
               arg_max(bought_at, ts) FILTER (WHERE bought_at IS NOT NULL) AS bought_at
        FROM s GROUP BY user_id
    )
    SELECT user_id, r.event_type, CAST(r.ts AS VARCHAR) AS loaded_at, r.event_id, r.value,
           CAST(m.viewed_at AS VARCHAR) AS viewed_at, CAST(m.clicked_at AS VARCHAR) AS clicked_at,
           CAST(m.bought_at AS VARCHAR) AS bought_at
    FROM m JOIN last_row r USING (user_id)
"""

ORACLES["staged_merge"] = f"""
    WITH s AS (
        SELECT *, CAST(ts AS DATE) AS slice_date FROM ({STAGED})
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY event_type, CAST(ts AS DATE), user_id ORDER BY ts DESC, event_id DESC) = 1
    ),
    last_row AS (SELECT * FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    m AS (
        SELECT user_id,
               arg_max(viewed_at, ts) FILTER (WHERE viewed_at IS NOT NULL) AS viewed_at,
               arg_max(clicked_at, ts) FILTER (WHERE clicked_at IS NOT NULL) AS clicked_at,
               arg_max(bought_at, ts) FILTER (WHERE bought_at IS NOT NULL) AS bought_at
        FROM s GROUP BY user_id
    )
    SELECT user_id, CAST(m.viewed_at AS VARCHAR) AS viewed_at, CAST(m.clicked_at AS VARCHAR) AS clicked_at,
           CAST(m.bought_at AS VARCHAR) AS bought_at, r.event_id, r.event_type
    FROM m JOIN last_row r USING (user_id)
"""

_LATEST_EVENT = """
    SELECT user_id, event_type, event_id, CAST(ts AS VARCHAR) AS ts, value FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY events.ts DESC, event_id DESC) = 1
"""
ORACLES["upsert_latest"] = _LATEST_EVENT
ORACLES["keyed_compaction"] = _LATEST_EVENT
ORACLES["incremental_ingest"] = _LATEST_EVENT
ORACLES["incremental_append"] = """
    SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, value, event_type FROM events
"""

ORACLES["snapshot_append"] = """
    SELECT event_id, user_id, value,
           CASE WHEN ts < TIMESTAMP '2024-01-15' THEN '2024-01-15' ELSE '2024-01-31' END AS snapshot_date
    FROM events
"""

ORACLES["stage_by_parameter"] = f"""
    SELECT event_type, strftime(ts, '%H') AS hour, COUNT(*) AS n,
           CAST(SUM(CASE WHEN event_type = 'click' THEN 0 ELSE {cents('value')} END) AS DOUBLE) AS total
    FROM events GROUP BY ALL
"""

ORACLES["full_refresh"] = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"

ORACLES["catalog_tables"] = f"""
    SELECT o_orderpriority, COUNT(*) AS n_orders, CAST(SUM(n) AS BIGINT) AS n_lines, MAX(total) AS largest
    FROM (
        SELECT o_orderkey, o_orderpriority, COUNT(*) AS n, CAST(SUM({cents('l_extendedprice')}) AS DOUBLE) AS total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    ) GROUP BY 1
"""

# --- projection, JSON, dimension lookup

ORACLES["reproject_points"] = """
    SELECT c_custkey, round(degrees((-13655000.0 + c_custkey * 10) / 6378137.0), 9) AS lon,
           round(degrees(2 * atan(exp((5703000.0 + c_acctbal) / 6378137.0)) - pi() / 2), 9) AS lat
    FROM customer
"""

ORACLES["json_fields"] = """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
"""

ORACLES["json_arrays_to_rows"] = f"""
    SELECT event_type, {day_text('ts')} AS day, event_id, user_id, value FROM events
"""

ORACLES["slice_source"] = f"""
    SELECT event_type, {day_text('ts')} AS slice_start, event_id, user_id, value
    FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
"""

ORACLES["dim_lookup"] = """
    SELECT s_suppkey, n_name || '_' || s_name AS id, s_acctbal
    FROM supplier JOIN nation ON n_nationkey = s_nationkey
"""

ORACLES["hot_key_lookup"] = f"""
    SELECT {day_text('l_shipdate')} AS date, p_type, {exact_sum('l_quantity')} AS qty, COUNT(*) AS n
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2
"""

ORACLES["dim_unmatched"] = """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
"""

# --- HTML and number parsing

_PLAIN = "replace(replace(replace(replace({}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_LINK = """<li><a href="([^"]*)">([^<]*)</a></li>"""

ITEMS = f"""
    SELECT page_id, page_url, html, i - 1 AS position, {_PLAIN.format('hrefs[i]')} AS url,
           {_PLAIN.format('texts[i]')} AS link_text
    FROM (
        SELECT page_id, url AS page_url, html, regexp_extract_all(html, '{_LINK}', 1) AS hrefs,
               regexp_extract_all(html, '{_LINK}', 2) AS texts
        FROM pages
    ), unnest(range(1, len(hrefs) + 1)) AS u(i)
"""

ORACLES["html_items"] = f"""
    SELECT page_id, CAST(position AS INTEGER) AS position, url, trim(link_text) AS link_text
    FROM ({ITEMS}) WHERE url <> ''
"""

_TEXT = """array_to_string(list_filter(list_transform(
    string_split_regex({part}, '<[^>]*>'), lambda x: trim({plain})), lambda x: x <> ''), '{sep}')"""


def _text(part: str, sep: str = "") -> str:
    return _TEXT.format(part=part, plain=_PLAIN.format("x"), sep=sep)


ORACLES["html_detail_join"] = f"""
    WITH details AS (
        SELECT url, {_text("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS heading,
               {_text("regexp_extract(html, '<div class=.ad.>(.*?)</div>', 1, 's')")} AS ad,
               {_text("regexp_extract(html, '<article>(.*?)</article>', 1, 's')", ' ')} AS body
        FROM pages
    ),
    items AS (
        SELECT page_url, position, CASE WHEN position = 0 THEN page_url ELSE url END AS url FROM ({ITEMS}) WHERE url <> ''
    )
    SELECT items.page_url, CAST(position AS INTEGER) AS position, items.url, heading, ad, body
    FROM items LEFT JOIN details ON details.url = items.url
"""

ORACLES["number_parse"] = f"""
    SELECT p_partkey,
           CAST(regexp_replace('1' || CAST({cents('p_retailprice')} AS VARCHAR), '[^0-9]', '', 'g') AS BIGINT) AS price,
           TRY_CAST(regexp_replace(p_name, '[^0-9]', '', 'g') AS BIGINT) AS no_digits,
           CAST(p_size + 1 AS DOUBLE) AS bedrooms, CAST(p_size AS DOUBLE) AS sqft
    FROM part
"""

# --- quality checks

ORACLES["key_unique_check"] = """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) > 1
"""

ORACLES["key_not_null_check"] = """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate IS NOT NULL)
"""

ORACLES["schema_report"] = """
    WITH declared(column_name, declared_type) AS (
        VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'int'), ('o_orderstatus', 'string'),
               ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_clerk', 'string')
    ),
    found AS (
        SELECT column_name, CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                                 WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS found_type
        FROM (
            SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
                           'o_orderpriority']) AS column_name,
                   unnest([typeof(o_orderkey), typeof(o_custkey), typeof(o_orderstatus), typeof(o_totalprice),
                           typeof(o_orderdate), typeof(o_orderpriority)]) AS data_type
            FROM (SELECT * FROM orders LIMIT 1)
        )
    ),
    filled AS (
        UNPIVOT (SELECT COUNT(o_orderkey) AS o_orderkey, COUNT(o_custkey) AS o_custkey,
                        COUNT(o_orderstatus) AS o_orderstatus, COUNT(o_totalprice) AS o_totalprice,
                        COUNT(o_orderdate) AS o_orderdate, COUNT(o_orderpriority) AS o_orderpriority FROM orders)
        ON COLUMNS(*) INTO NAME column_name VALUE n_filled
    )
    SELECT column_name,
           CASE WHEN found_type IS NULL THEN 'missing' WHEN declared_type IS NULL THEN 'extra'
                WHEN found_type = declared_type THEN 'ok' ELSE 'mistyped' END AS status,
           declared_type, found_type, t.n AS n_rows, t.n - n_filled AS n_null
    FROM declared FULL JOIN found USING (column_name) LEFT JOIN filled USING (column_name)
    CROSS JOIN (SELECT COUNT(*) AS n FROM orders) t
"""

# --- permit models

RAW = f"""
    SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) || '.0' AS key_text,
           lpad(CAST(l_orderkey AS VARCHAR), 11, '0')
               || CASE WHEN l_returnflag = 'N' THEN '-001-' ELSE '-000-' END || 'CO' AS code,
           CASE WHEN l_linenumber < 6 THEN CASE o_orderstatus
               WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Under Review' WHEN 'P' THEN 'Expired' END END AS status,
           CASE p_type WHEN 'STANDARD' THEN 'Single Family Dwelling' WHEN 'MEDIUM' THEN 'Duplex'
               WHEN 'LARGE' THEN 'Apartments/Condos (3 or more units)' WHEN 'SMALL' THEN 'Garage/Carport'
               WHEN 'ECONOMY' THEN 'Storage' WHEN 'PROMO' THEN 'Tower' END AS kind,
           p_name AS description,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'New Construction' WHEN '2-HIGH' THEN 'Addition'
               WHEN '3-MEDIUM' THEN 'Alteration' WHEN '4-NOT SPECIFIED' THEN 'nan'
               WHEN '5-LOW' THEN 'Demolition' END AS work_text,
           'Lot ' || CAST(o_custkey AS VARCHAR) AS address,
           {day_text('o_orderdate')} AS set_up_text,
           CAST(CAST(o_orderdate AS DATE) + l_linenumber AS VARCHAR) AS review_text,
           CASE WHEN l_linenumber = 5 THEN 'nan' ELSE {day_text('l_shipdate')} END AS issued_text,
           CASE WHEN l_linestatus = 'O' THEN 'nan'
               ELSE CAST(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS VARCHAR) END AS final_text,
           'Hood ' || CAST(l_suppkey AS VARCHAR) AS hood, l_returnflag AS district, l_linestatus AS association,
           ['A-2', 'B', 'E', 'F-1', 'H', 'I-2', 'R-3', 'S-1', 'SR', 'U', 'U1', NULL, NULL, NULL][p_size % 14 + 1]
               AS occupancy,
           p_brand AS construction,
           CASE WHEN l_linenumber = 7 THEN 'nan' ELSE CAST({cents('l_extendedprice')} AS VARCHAR) END AS submitted_text,
           CASE WHEN l_linestatus = 'O' THEN 'nan' ELSE CAST({cents('o_totalprice')} AS VARCHAR) END AS value_text,
           CAST(CAST(l_tax * 100 AS INTEGER) AS VARCHAR) AS units_text,
           CASE WHEN l_linenumber = 6 THEN 'nan' ELSE CAST(CAST(l_quantity * 10 AS INTEGER) AS VARCHAR) END AS area_text,
           CAST(p_size % 5 AS VARCHAR) AS stories_text,
           CAST(o_custkey AS VARCHAR) || '.0' AS customer_text,
           '-122.' || CAST(l_suppkey AS VARCHAR) AS lon_text,
           CASE WHEN l_linenumber = 2 THEN 'nan' ELSE '45.' || CAST(l_suppkey AS VARCHAR) END AS lat_text,
           {day_text('o_orderdate')} AS loaded_text
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
"""


TYPED = f"""
    SELECT {_whole('key_text')} AS ivr_number, code AS application_number, status,
           kind AS type, description, NULLIF(work_text, 'nan') AS work, address,
           TRY_CAST(set_up_text AS TIMESTAMP) AS set_up_at, TRY_CAST(review_text AS TIMESTAMP) AS under_review_at,
           TRY_CAST(issued_text AS TIMESTAMP) AS issued_at, TRY_CAST(final_text AS TIMESTAMP) AS final_at,
           hood AS neighborhood, district AS neighborhood_coalition, association AS business_association,
           occupancy AS occupancy_group, construction AS construction_type,
           {_number('submitted_text')} AS submitted_valuation_amt, {_number('value_text')} AS final_valuation_amt,
           {_number('units_text')} AS new_units_amt, {_number('area_text')} AS total_sqft_amt,
           COALESCE({_number('area_text')} > 0, FALSE) AS has_square_footage,
           {_number('stories_text')} AS stories_amt,
           {_whole('customer_text')} AS customer,
           {_number('lon_text')} AS longitude, {_number('lat_text')} AS latitude,
           {_number('lon_text')} + {_number('lat_text')} AS location,
           TRY_CAST(loaded_text AS TIMESTAMP) AS updated_at
    FROM ({RAW})
"""

_TIMES = ["set_up_at", "under_review_at", "issued_at", "final_at"]
_TIES = [
    "application_number", "status", "type", "description", "work", "address", *_TIMES, "neighborhood",
    "neighborhood_coalition", "business_association", "occupancy_group", "construction_type",
    "submitted_valuation_amt", "final_valuation_amt", "new_units_amt", "total_sqft_amt", "has_square_footage",
    "stories_amt", "customer", "longitude", "latitude", "updated_at",
]

CLEANED = f"""
    WITH typed AS ({TYPED}),
    kept AS (
        SELECT * FROM typed WHERE substr(application_number, 12, 5) = '-000-'
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY ivr_number ORDER BY greatest(issued_at, under_review_at), {', '.join(_TIES)}) = 1
    )
    SELECT ivr_number, application_number, status, type, description,
           CASE work WHEN 'Addition' THEN 'Addition/Alteration' WHEN 'Alteration' THEN 'Addition/Alteration'
                ELSE work END AS work_type,
           address, set_up_at, under_review_at, issued_at, final_at,
           greatest(set_up_at, under_review_at, issued_at, final_at) AS last_status_update_at,
           CAST(datediff('day', set_up_at, issued_at) AS BIGINT) AS days_to_issue,
           CAST(datediff('day', issued_at, final_at) AS BIGINT) AS days_to_final,
           neighborhood, neighborhood_coalition, business_association, occupancy_group, construction_type,
           COALESCE(final_valuation_amt, submitted_valuation_amt) AS value,
           COALESCE(final_valuation_amt, submitted_valuation_amt) / NULLIF(total_sqft_amt, 0) AS dollars_per_sf,
           total_sqft_amt / NULLIF(stories_amt, 0) AS sf_per_story,
           new_units_amt, total_sqft_amt, has_square_footage, stories_amt, customer, longitude, latitude, location,
           CASE type WHEN 'Duplex' THEN 'Rowhouse, Townhouse, Duplex'
                WHEN 'Apartments/Condos (3 or more units)' THEN 'Apartments'
                WHEN 'Single Family Dwelling' THEN 'Single Family Detached'
                WHEN 'Garage/Carport' THEN 'Accessory Structures' ELSE type END AS structure_type,
           CASE WHEN left(occupancy_group, 1) = 'A' THEN 'Commercial'
                WHEN left(occupancy_group, 1) = 'B' THEN 'Office'
                WHEN left(occupancy_group, 1) = 'E' THEN 'School'
                WHEN left(occupancy_group, 1) IN ('F', 'H') THEN 'Industrial'
                WHEN left(occupancy_group, 1) = 'I' THEN 'Healthcare'
                WHEN left(occupancy_group, 1) = 'R'
                     OR type IN ('Garage/Carport', 'Duplex', 'Single Family Dwelling')
                     OR type LIKE 'Apartments%' THEN 'Residential'
                WHEN left(occupancy_group, 2) IN ('U', 'S-', 'SR') OR type = 'Storage'
                     THEN 'Utility, Storage, Parking, Special'
                ELSE type END AS function_type,
           updated_at
    FROM kept
"""

_SHOWN = [*_TIMES, "updated_at"]


def _as_text(names: list[str]) -> str:
    return ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in names)


ORACLES["permits_typed"] = f"SELECT * REPLACE ({_as_text(_SHOWN)}) FROM ({TYPED})"
ORACLES["permits_cleaned"] = f"SELECT * REPLACE ({_as_text([*_SHOWN, 'last_status_update_at'])}) FROM ({CLEANED})"
ORACLES["permits_typed_literal_flag"] = f"""
    SELECT COALESCE(CAST(area_text AS DOUBLE) > 0, FALSE) AS has_square_footage, COUNT(*) AS n,
           COUNT({_number('area_text')}) AS n_area
    FROM ({RAW}) GROUP BY 1
"""

_WAITING = """s.date >= CAST(set_up_at AS DATE) AND s.date < COALESCE(CAST(issued_at AS DATE), DATE '2001-08-01')
              AND status <> 'Expired' AND status <> 'Abandoned'"""


def _sides(category: str | None) -> str:
    """Issue and review rollups, joined to the calendar before they are aggregated."""
    key, large = (f", {category}", "AND total_sqft_amt > 100") if category else ("", "")
    group = "GROUP BY ALL"
    return f"""
    WITH spine AS ({SPINE}), cleaned AS ({CLEANED}),
    i AS (
        SELECT s.date{key}, SUM(total_sqft_amt) AS total_sqft_issued_amt, SUM(new_units_amt) AS total_new_units_issued_amt,
               COUNT(ivr_number) AS count_permits_issued, COUNT(total_sqft_amt) AS count_permits_issued_w_sqft,
               COUNT(value) AS final_valuation_issued_amount, AVG(days_to_issue) AS avg_days_to_issue,
               COALESCE(SUM(days_to_issue), 0) / NULLIF(SUM(total_sqft_amt), 0) AS days_to_issue_sqft,
               COALESCE(SUM(days_to_issue) FILTER (WHERE new_units_amt > 0), 0) / NULLIF(SUM(new_units_amt), 0)
                   AS days_to_issue_new_units
        FROM spine s LEFT JOIN cleaned ON CAST(issued_at AS DATE) = s.date {large} {group}
    ),
    r AS (
        SELECT s.date{key}, COALESCE(SUM(total_sqft_amt), 0) AS total_sqft_review_amt,
               COALESCE(SUM(new_units_amt), 0) AS total_new_units_review_amt,
               SUM(total_sqft_amt) FILTER (WHERE {_WAITING}) AS total_sqft_waiting_approval,
               SUM(new_units_amt) FILTER (WHERE {_WAITING}) AS total_new_units_waiting_approval,
               COUNT(ivr_number) AS count_permits_review, COUNT(total_sqft_amt) AS count_permits_review_w_sqft,
               COUNT(value) AS final_valuation_review_amount
        FROM spine s LEFT JOIN cleaned ON CAST(under_review_at AS DATE) = s.date {large} {group}
    )"""


_PER_DAY = f"""{_sides(None)},
    f AS (
        SELECT s.date, COALESCE(SUM(total_sqft_amt), 0) AS total_sqft_final_amt,
               COALESCE(SUM(new_units_amt), 0) AS total_new_units_final_amt,
               COALESCE(SUM(new_units_amt), 0) AS total_new_units_amt,
               COUNT(ivr_number) AS count_permits_final, COUNT(total_sqft_amt) AS count_permits_final_w_sqft,
               COUNT(value) AS final_valuation_amount
        FROM spine s LEFT JOIN cleaned ON CAST(final_at AS DATE) = s.date GROUP BY 1
    ),
    per_day AS (SELECT * FROM i JOIN r USING (date) JOIN f USING (date))"""

ORACLES["permits_by_date"] = f"{_PER_DAY} SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM per_day"

ORACLES["permit_tables"] = ORACLES["permits_by_date"]

ORACLES["rolling_permits_timeseries"] = f"""{_PER_DAY},
    w AS (
        SELECT date, AVG(total_sqft_issued_amt) OVER t AS total_sqft_issued_amt,
               AVG(total_new_units_issued_amt) OVER t AS total_new_units_issued_amt,
               AVG(count_permits_issued) OVER t AS count_permits_issued,
               CAST(SUM(count_permits_issued) OVER t AS BIGINT) AS count_total_permits_issued
        FROM per_day WHERE date > DATE '1996-01-01'
        WINDOW t AS (ORDER BY date DESC ROWS BETWEEN CURRENT ROW AND 365 FOLLOWING)
    )
    SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM w WHERE date > DATE '1997-01-01' ORDER BY w.date
"""

for _category in ("function_type", "structure_type", "work_type"):
    _combined = f"""{_sides(_category)},
    c AS (
        SELECT i.date, COALESCE(i.{_category}, r.{_category}) AS {_category}, i.* EXCLUDE (date, {_category}),
               r.* EXCLUDE (date, {_category})
        FROM i FULL JOIN r ON i.date = r.date AND i.{_category} = r.{_category}
    )"""
    ORACLES[f"permits_by_date_and_{_category}"] = f"{_combined} SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM c"
    ORACLES[f"rolling_permits_by_{_category}"] = f"""{_combined},
    w AS (
        SELECT d.date, k.type, AVG(COALESCE(c.total_sqft_issued_amt, 0)) OVER (
            PARTITION BY k.type ORDER BY d.date ROWS 365 PRECEDING) AS value
        FROM (SELECT DISTINCT date FROM c WHERE date > DATE '1996-01-01') d
        CROSS JOIN (SELECT DISTINCT {_category} AS type FROM c WHERE {_category} IS NOT NULL) k
        LEFT JOIN c ON c.date = d.date AND c.{_category} = k.type
    )
    SELECT CAST(date AS VARCHAR) AS date, type, value FROM w WHERE date > DATE '1997-01-01' ORDER BY type, w.date
    """

ORACLES["this_week_permits"] = f"""
    SELECT structure_type AS Structure, {day_text('under_review_at')} AS Submitted, {day_text('issued_at')} AS Issued,
           work_type AS Type_of_Work, function_type AS Building_Function, total_sqft_amt AS New_Square_Feet,
           stories_amt AS Buildings_Stories, new_units_amt AS New_Residential_Units, value AS Construction_Value,
           description AS Description
    FROM ({CLEANED})
    WHERE CAST(issued_at AS DATE) BETWEEN DATE '2001-07-25' AND DATE '2001-08-01' AND total_sqft_amt > 0
    ORDER BY Issued DESC, round_even(total_sqft_amt, 0) DESC, Construction_Value, Description
"""

ORACLES["top_neighborhoods"] = f"""
    SELECT hood AS neighborhood, COUNT(*) AS permits, round(AVG(CAST(submitted_text AS DOUBLE)), 4) AS avg_valuation
    FROM ({RAW}) WHERE submitted_text <> 'nan' GROUP BY 1 ORDER BY permits DESC, neighborhood LIMIT 20
"""

ORACLES["issued_by_neighborhood"] = f"""
    SELECT hood AS neighborhood, COUNT(*) AS permits FROM ({RAW}) WHERE issued_text <> 'nan'
    GROUP BY 1 ORDER BY permits DESC, neighborhood
"""

# --- the three ingest jobs

ORACLES["permit_ingest"] = f"""
    WITH raw AS ({RAW}),
    landed AS (
        SELECT key_text AS ivr_number, code AS application_number, address, hood, district, association, description,
               NULLIF(work_text, 'nan') AS work, {_number('submitted_text')} AS submitted_valuation,
               {_number('value_text')} AS final_valuation, {_number('area_text')} AS total_sqft,
               {_number('stories_text')} AS stories, {_number('units_text')} AS new_units, stage,
               CASE WHEN stage = 'review' THEN review_text END AS under_review,
               CASE WHEN stage = 'issued' THEN issued_text END AS issued,
               CASE WHEN stage = 'final' THEN final_text END AS final,
               date_trunc('year', TRY_CAST(CASE stage WHEN 'review' THEN review_text WHEN 'issued' THEN issued_text
                                           ELSE final_text END AS DATE)) AS slice_date,
               degrees((-13655000 + CAST(left(code, 11) AS INTEGER)) / 6378137.0) AS lon,
               CASE WHEN lat_text <> 'nan' THEN degrees(2 * atan(exp(5703000 / 6378137.0)) - pi() / 2) END AS lat
        FROM raw, unnest(['review', 'issued', 'final']) AS u(stage)
    ),
    staged AS (
        SELECT * FROM landed WHERE slice_date IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY stage, slice_date, ivr_number
            ORDER BY application_number DESC, address DESC, hood DESC, district DESC, association DESC,
                     description DESC, work DESC NULLS LAST, submitted_valuation DESC NULLS LAST,
                     final_valuation DESC NULLS LAST, total_sqft DESC NULLS LAST, stories DESC NULLS LAST,
                     new_units DESC NULLS LAST, under_review DESC NULLS LAST, issued DESC NULLS LAST,
                     final DESC NULLS LAST, lon DESC, lat DESC NULLS LAST) = 1
    ),
    last_row AS (
        SELECT * FROM staged QUALIFY ROW_NUMBER() OVER (PARTITION BY ivr_number ORDER BY slice_date DESC, stage DESC) = 1
    ),
    dates AS (
        SELECT ivr_number,
               arg_max(under_review, slice_date) FILTER (WHERE under_review IS NOT NULL) AS under_review,
               arg_max(issued, slice_date) FILTER (WHERE issued IS NOT NULL) AS issued,
               arg_max(final, slice_date) FILTER (WHERE final IS NOT NULL) AS final
        FROM staged GROUP BY ivr_number
    )
    SELECT ivr_number, r.application_number, d.under_review, d.issued, d.final, r.work, r.total_sqft,
           r.submitted_valuation, round(r.lon, 9) AS lon, round(r.lat, 9) AS lat
    FROM dates d JOIN last_row r USING (ivr_number)
"""

ORACLES["listing_ingest"] = """
    SELECT c_mktsegment AS region, '/apa/' || CAST(c_custkey AS VARCHAR) AS url,
           CASE WHEN c_nationkey <> 3 THEN '2024-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') END AS posted,
           CAST(floor(abs(c_acctbal)) AS BIGINT) AS price,
           CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey % 4 AS DOUBLE) END AS bedrooms,
           CASE WHEN c_nationkey <> 3 THEN CAST(c_custkey AS DOUBLE) END AS sqft,
           'N&' || CAST(c_nationkey AS VARCHAR) AS neighborhood, c_name AS title, CAST(NULL AS VARCHAR) AS address,
           CASE WHEN c_nationkey <> 3 THEN 'Home of ' || c_name END AS post_description,
           CASE WHEN c_nationkey <> 3 THEN 45.5::DOUBLE END AS latitude,
           CASE WHEN c_nationkey <> 3 THEN CAST('-122.' || CAST(c_nationkey AS VARCHAR) AS DOUBLE) END AS longitude,
           '2024-01-31' AS snapshot_date
    FROM customer WHERE c_nationkey <> 5
"""

ORACLES["listing_medians"] = f"""
    SELECT c_mktsegment AS region, COUNT(*) AS listings,
           round(MEDIAN(CAST({cents('c_acctbal')} AS DOUBLE)), 4) AS median_rent,
           MEDIAN(CASE WHEN c_nationkey <> 5 THEN CAST(c_custkey AS DOUBLE) END) AS median_sqft
    FROM customer WHERE c_nationkey <> 3 GROUP BY 1 ORDER BY median_rent DESC, region
"""

ORACLES["weather_ingest"] = f"""
    SELECT 'city' || CAST(user_id AS VARCHAR) || '_' || {day_text('ts')} AS id, 'city' || CAST(user_id AS VARCHAR) AS city,
           {day_text('ts')} AS date, MAX(value) AS temp_max_c, MIN(value) AS temp_min_c,
           COUNT(*) + CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN 100.0::DOUBLE ELSE 0 END AS precipitation_mm,
           2 * (COUNT(*) + CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN 100.0::DOUBLE ELSE 0 END)
               AS windspeed_max_kmh
    FROM events GROUP BY user_id, CAST(ts AS DATE)
"""

ORACLES["ingest_report"] = """
    WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    payloads AS (SELECT DISTINCT user_id, date_trunc('month', day) AS month FROM days),
    good AS (SELECT user_id, day, user_id % 11 = 5 AS nameless FROM days WHERE user_id % 7 <> 3)
    SELECT 'n_payloads' AS measure, 2 * COUNT(*) AS n FROM payloads
    UNION ALL SELECT 'n_rejected', 2 * COUNT(*) FROM payloads WHERE user_id % 7 = 3
    UNION ALL SELECT 'n_rows', 2 * COUNT(*) FROM good
    UNION ALL SELECT 'n_null_keys', 2 * COUNT(*) FROM good WHERE nameless
    UNION ALL SELECT 'n_stored', COUNT(*) FILTER (WHERE NOT nameless) + CAST(bool_or(nameless) AS INTEGER) FROM good
"""


def _key_report(name: str) -> str:
    return f"""
        SELECT '{name}' AS model, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE ivr_number IS NULL) AS n_null_keys,
               (SELECT COUNT(*) FROM (SELECT ivr_number FROM ({ORACLES[name]}) WHERE ivr_number IS NOT NULL
                                      GROUP BY ivr_number HAVING COUNT(*) > 1)) AS n_repeated_keys
        FROM ({ORACLES[name]})
    """


ORACLES["permit_key_checks"] = f"{_key_report('permits_typed')} UNION ALL {_key_report('permits_cleaned')}"
