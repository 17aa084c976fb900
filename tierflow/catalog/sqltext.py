"""SQL texts of the domain frames, prefixed to a query as needed."""

from __future__ import annotations

import re


def r(expr: str, digits: int) -> str:
    """SQL twin of ``columns.rounded``."""
    scale = f"{10**digits}.0"
    return f"floor(CAST({expr} AS DOUBLE) * CAST({scale} AS DOUBLE) + CAST(0.50001 AS DOUBLE)) / CAST({scale} AS DOUBLE)"


FRAMES: dict[str, str] = {
    "places": """
  SELECT n_nationkey, n_name, r_name AS region,
         'N' || translate(lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), '0123456789', 'ABCDEFGHIJ') AS country_code
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fans": """
  SELECT event_id AS interaction_id,
         CASE WHEN user_id % 3 = 0 THEN 'VERIFIED' ELSE 'GUEST' END AS account_type,
         CASE WHEN user_id % 3 = 0 THEN user_id END AS fan_id,
         'S-' || user_id AS session_id,
         CASE WHEN user_id % 3 = 0 THEN 'user' || user_id || '@example.com' END AS email,
         CASE WHEN user_id % 3 = 0 THEN c_mktsegment END AS first_name,
         CASE WHEN user_id % 3 = 0 THEN c_name END AS last_name,
         region, country_code,
         CASE WHEN event_type = 'view' THEN 'STREAM' ELSE upper(event_type) END AS event_type,
         ts - INTERVAL 9496 DAY AS event_ts,
         CAST(props->>'$.k' AS BIGINT) AS title_id,
         (['iOS', 'Android', 'Web', 'SmartTV', 'PlayStation'])[1 + event_id % 5] AS device_type,
         CAST(value AS DECIMAL(18,2)) AS value
  FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN places ON c_nationkey = n_nationkey""",
    "titles_raw": """
  SELECT p_partkey AS version, p_partkey % 100 AS title_id, p_name || ' #' || (p_partkey % 100) AS title_name,
         p_brand AS franchise, p_type AS genre, (['G', 'PG', 'PG-13', 'R'])[1 + p_size % 4] AS rating,
         CASE WHEN p_size % 2 = 0 THEN 'RELEASED' ELSE 'POST_PRODUCTION' END AS production_status,
         'Director ' || (p_size % 10) AS director, 1995 + p_size % 6 AS release_year,
         make_date(1995 + p_size % 6, p_partkey % 12 + 1, 1) AS release_date,
         p_size AS runtime_minutes,
         CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS DOUBLE) / 5 END AS imdb_score,
         CAST(p_retailprice AS DECIMAL(15,2)) AS budget_usd
  FROM part""",
    "titles": """
  SELECT * EXCLUDE (version) FROM titles_raw
  QUALIFY row_number() OVER (PARTITION BY title_id ORDER BY version DESC) = 1""",
    "box": """
  SELECT l_orderkey * 10 + l_linenumber AS record_id, l_partkey % 100 AS title_id, l_suppkey AS theater_id,
         s_name AS theater_name, CAST(l_shipdate AS DATE) AS report_date, region, country_code,
         (['USD', 'EUR', 'GBP', 'JPY', 'BRL'])[1 + n_nationkey % 5] AS local_currency,
         CAST(l_quantity AS INTEGER) AS tickets_sold, l_linenumber AS screen_count,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS gross_local,
         CAST(l_extendedprice AS DECIMAL(15,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS gross_usd,
         o_orderdate AS ingestion_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN places ON s_nationkey = n_nationkey""",
    "box_dedup": """
  SELECT * FROM box
  QUALIFY row_number() OVER (PARTITION BY title_id, report_date, theater_id
          ORDER BY ingestion_ts DESC, record_id DESC, gross_usd DESC, tickets_sold DESC) = 1""",
    "theatrical_daily": """
  SELECT title_id, report_date, region, CAST(sum(tickets_sold) AS BIGINT) AS total_tickets_sold,
         sum(gross_usd) AS total_gross_usd, count(DISTINCT theater_id) AS theater_count,
         CAST(sum(screen_count) AS BIGINT) AS screen_count,
         avg(CAST(gross_usd AS DOUBLE) / nullif(CAST(tickets_sold AS DOUBLE), 0)) AS avg_ticket_price_usd
  FROM box_dedup GROUP BY title_id, report_date, region""",
    "fan_daily": """
  SELECT title_id, CAST(event_ts AS DATE) AS report_date, region,
         count(*) FILTER (WHERE event_type = 'STREAM') AS stream_count, count(DISTINCT fan_id) AS unique_fans
  FROM fans GROUP BY title_id, CAST(event_ts AS DATE), region""",
    "fact": """
  SELECT md5(concat_ws('-', coalesce(CAST(title_id AS VARCHAR), '_null_'), coalesce(CAST(report_date AS VARCHAR), '_null_'),
                       coalesce(region, '_null_'))) AS performance_key, *
  FROM (SELECT coalesce(d.title_id, f.title_id) AS title_id, coalesce(d.report_date, f.report_date) AS report_date,
               coalesce(d.region, f.region) AS region, coalesce(total_tickets_sold, 0) AS total_tickets_sold,
               coalesce(total_gross_usd, 0) AS total_gross_usd, coalesce(theater_count, 0) AS theater_count,
               coalesce(screen_count, 0) AS screen_count, coalesce(avg_ticket_price_usd, 0) AS avg_ticket_price_usd,
               coalesce(stream_count, 0) AS stream_count, coalesce(unique_fans, 0) AS unique_fans
        FROM theatrical_daily d FULL OUTER JOIN fan_daily f
          ON d.title_id = f.title_id AND d.report_date = f.report_date AND d.region = f.region) j""",
    "fan_mode": """
  SELECT fan_id, min(device_type) FILTER (WHERE rk = 1) AS preferred_device
  FROM (SELECT fan_id, device_type, rank() OVER (PARTITION BY fan_id ORDER BY count(*) DESC) AS rk
        FROM fans WHERE fan_id IS NOT NULL GROUP BY fan_id, device_type) m GROUP BY fan_id""",
    "dim_fans": """
  SELECT md5(CAST(s.fan_id AS VARCHAR)) AS fan_key, s.fan_id, d.account_type, d.email, sha256(d.email) AS email_hash,
         d.first_name, d.last_name, d.region, d.country_code, CAST(s.first_seen AS DATE) AS signup_date,
         CAST(s.last_seen AS DATE) AS last_active_date, s.interaction_count AS lifetime_interactions,
         s.titles_engaged, m.preferred_device
  FROM (SELECT fan_id, min(event_ts) AS first_seen, max(event_ts) AS last_seen, count(*) AS interaction_count,
               count(DISTINCT title_id) AS titles_engaged
        FROM fans WHERE fan_id IS NOT NULL GROUP BY fan_id) s
  JOIN fan_mode m USING (fan_id)
  JOIN (SELECT * FROM fans WHERE fan_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY fan_id ORDER BY event_ts DESC, interaction_id DESC) = 1) d USING (fan_id)""",
    "dim_titles": "SELECT md5(CAST(title_id AS VARCHAR)) AS title_key, * FROM titles",
    "agg_franchise": """
  SELECT franchise, genre, count(DISTINCT t.title_id) AS title_count,
         CAST(sum(total_tickets_sold) AS BIGINT) AS total_tickets, sum(f.total_gross_usd) AS total_gross_usd,
         avg(avg_ticket_price_usd) AS avg_ticket_price, CAST(sum(stream_count) AS BIGINT) AS total_streams,
         CAST(sum(unique_fans) AS BIGINT) AS total_unique_fans, min(report_date) AS first_report_date,
         max(report_date) AS last_report_date,
         CAST(sum(f.total_gross_usd) AS DOUBLE) / nullif(CAST(sum(total_tickets_sold) AS DOUBLE), 0) AS weighted_ticket_price
  FROM fact f JOIN dim_titles t ON f.title_id = t.title_id GROUP BY franchise, genre""",
    "agg_fan_value": """
  SELECT region, country_code, account_type, count(DISTINCT fan_id) AS fan_count,
         avg(lifetime_interactions) AS avg_interactions, avg(titles_engaged) AS avg_titles_engaged,
         avg(date_diff('day', signup_date, last_active_date)) AS avg_active_days,
         count(*) FILTER (WHERE last_active_date >= a.d - 30) AS active_last_30_days,
         count(*) FILTER (WHERE last_active_date >= a.d - 7) AS active_last_7_days,
         min(top_device) AS top_device
  FROM dim_fans
  JOIN (SELECT region, country_code, account_type, min(preferred_device) FILTER (WHERE rk = 1) AS top_device
        FROM (SELECT region, country_code, account_type, preferred_device,
                     rank() OVER (PARTITION BY region, country_code, account_type ORDER BY count(*) DESC) AS rk
              FROM dim_fans GROUP BY region, country_code, account_type, preferred_device) x
        GROUP BY region, country_code, account_type) td USING (region, country_code, account_type),
       (SELECT max(CAST(event_ts AS DATE)) AS d FROM fans) a
  GROUP BY region, country_code, account_type""",
}


def with_frames(sql: str) -> str:
    """Prefixes the frames a text mentions, in definition order, with those they mention in turn."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in FRAMES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(body)
    if not needed:
        return sql
    frames = ",\n".join(f"{n} AS ({b})" for n, b in FRAMES.items() if n in needed)
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {frames},\n{text[5:]}"
    return f"WITH {frames}\n{text}"
