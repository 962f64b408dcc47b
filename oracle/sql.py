"""Independent SQL for the registered queries, over the raw test tables.

Parameters and items are long tables here, sessions are found by numbering single events, and
events meet their session by an interval join; the Spark side does none of this.
"""

from __future__ import annotations

import re

# Named building blocks; each may use the ones before it.
PARTS: dict[str, str] = {
    "squeezed": """
        SELECT event_id, value, event_type, user_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               1704067200000000 + 82800000000
                 + ((epoch_us(ts) - 1704067200000000) // 259200000000) * 86400000000
                 + ((((epoch_us(ts) - 1704067200000000) % 259200000000) // 36) // 15000000) * 15000000
                 AS us
        FROM events""",
    "ev": """
        SELECT event_id, k, value, CASE WHEN event_id % 101 <> 7 THEN us END AS event_timestamp,
               strftime(make_timestamp(us), '%Y%m%d') AS event_date,
               CASE WHEN user_id % 50 <> 49 THEN 'u' || user_id END AS user_pseudo_id,
               CASE WHEN event_type = 'view' THEN 'page_view'
                    WHEN event_type = 'purchase' THEN 'purchase'
                    WHEN event_type = 'click' AND k % 3 = 0 THEN 'view_item'
                    WHEN event_type = 'click' AND k % 3 = 1 THEN 'add_to_cart'
                    WHEN event_type = 'click' THEN 'scroll'
                    WHEN event_type = 'signup' AND k % 2 = 0 THEN 'begin_checkout'
                    WHEN event_type = 'signup' THEN 'view_item'
                    WHEN event_type = 'error' AND k % 2 = 0 THEN 'user_engagement'
                    WHEN event_type = 'error' THEN 'page_view' END AS event_name,
               (k + 100 * (event_id % ((SELECT count(*) FROM pages) // 100 + 1)))
                 % (SELECT count(*) FROM pages) AS page_no
        FROM squeezed""",
    "prm": """
        SELECT e.event_date, e.event_timestamp, e.event_name, e.user_pseudo_id,
               p.param_name, p.param_value, p.int_value
        FROM ev e
        LEFT JOIN pages loc ON loc.page_id = e.page_no
        LEFT JOIN pages ref ON ref.page_id = (e.page_no * 7) % (SELECT count(*) FROM pages),
        LATERAL (
            SELECT 'page_location' AS param_name,
                   CASE WHEN k % 19 = 0 THEN upper(loc.url)
                        WHEN k % 7 = 0 THEN loc.url || '#v' || (k % 3)
                        ELSE loc.url END AS param_value,
                   CAST(NULL AS BIGINT) AS int_value WHERE k % 17 <> 0
            UNION ALL SELECT 'page_title', 'Title ' || page_no, NULL WHERE k % 11 <> 0
            UNION ALL SELECT 'page_referrer', ref.url, NULL WHERE k % 3 <> 0
            UNION ALL SELECT 'ga_session_id', CAST(event_id // 10 AS VARCHAR), event_id // 10
            UNION ALL SELECT 'ga_session_number', CAST(1 + k % 5 AS VARCHAR), 1 + k % 5
            UNION ALL SELECT 'source', ['google', '(direct)', '<Other>', '(data deleted)'][(k // 4) % 4 + 1],
                             NULL WHERE k % 4 = 0
            UNION ALL SELECT 'medium', CASE WHEN k % 16 = 0 THEN 'organic' ELSE 'cpc' END, NULL WHERE k % 8 = 0
            UNION ALL SELECT 'campaign', '(referral)', NULL WHERE k % 20 = 0
            UNION ALL SELECT 'percent_scrolled', CASE WHEN k % 2 = 0 THEN '90' ELSE 'n/a' END,
                             CASE WHEN k % 2 = 0 THEN 90 END WHERE event_name = 'scroll'
            UNION ALL SELECT 'value', regexp_replace(CAST(value AS VARCHAR), '\\.0$', ''), NULL
                      WHERE value IS NOT NULL
        ) p
        WHERE e.k NOT IN (97, 98)""",
    "itm": """
        SELECT e.event_date, e.event_timestamp, e.event_name, e.user_pseudo_id,
               CASE WHEN (e.k + n.j) % 29 <> 0 THEN 'P' || p.p_partkey END AS item_id,
               p.p_name AS item_name, p.p_brand AS item_brand, p.p_type AS item_category,
               'size' || p.p_size AS item_category2,
               CAST(NULL AS VARCHAR) AS item_category3, CAST(NULL AS VARCHAR) AS item_category4,
               CAST(NULL AS VARCHAR) AS item_category5,
               CASE WHEN e.k % 13 <> 0 THEN p.p_retailprice END AS price,
               1 + e.k % 4 AS quantity,
               CAST(NULL AS VARCHAR) AS item_variant, CAST(NULL AS VARCHAR) AS item_list_name,
               CAST(NULL AS VARCHAR) AS item_list_id, CAST(NULL AS VARCHAR) AS promotion_id,
               CAST(NULL AS VARCHAR) AS promotion_name, CAST(NULL AS VARCHAR) AS coupon
        FROM ev e
        JOIN (VALUES (0), (1), (2)) n(j) ON n.j <= e.k % 3
        JOIN part p ON p.p_partkey = (e.event_id * 3 + n.j) % (SELECT count(*) FROM part)
        WHERE e.event_name IN ('view_item', 'add_to_cart', 'begin_checkout', 'purchase')""",
    "gaps": """
        SELECT user_pseudo_id, event_timestamp, event_name, event_date,
               lag(event_timestamp) OVER (PARTITION BY user_pseudo_id ORDER BY event_timestamp NULLS FIRST) AS earlier
        FROM ev""",
    "numbered": """
        SELECT user_pseudo_id, event_timestamp, event_name, event_date,
               CAST(count(*) FILTER (WHERE earlier IS NULL
                        OR date_sub('minute', make_timestamp(earlier), make_timestamp(event_timestamp)) > 30)
                    OVER (PARTITION BY user_pseudo_id ORDER BY event_timestamp NULLS FIRST) AS BIGINT) AS session_number
        FROM gaps""",
    "ses": """
        SELECT user_pseudo_id, session_number,
               min(event_timestamp) AS us0, max(event_timestamp) AS us1,
               make_timestamp(min(event_timestamp)) AS session_start,
               make_timestamp(max(event_timestamp)) AS session_end,
               count(*) AS event_count,
               count(*) FILTER (WHERE event_name = 'user_engagement') AS engaged_event_count,
               strptime(min(event_date), '%Y%m%d')::DATE AS session_date,
               (max(event_timestamp) - min(event_timestamp)) // 1000000 AS session_duration_seconds
        FROM numbered GROUP BY ALL""",
    "shared": """
        SELECT user_pseudo_id, event_timestamp,
               max(param_value) FILTER (WHERE param_name = 'page_location') AS page_location,
               max(param_value) FILTER (WHERE param_name = 'page_title') AS page_title,
               max(param_value) FILTER (WHERE param_name = 'page_referrer') AS page_referrer,
               max(param_value) FILTER (WHERE param_name = 'source') AS traffic_source,
               max(param_value) FILTER (WHERE param_name = 'medium') AS traffic_medium,
               max(param_value) FILTER (WHERE param_name = 'campaign') AS traffic_campaign,
               max(TRY_CAST(param_value AS DOUBLE)) FILTER (WHERE param_name = 'percent_scrolled')
                 AS percent_scrolled,
               max(int_value) FILTER (WHERE param_name = 'ga_session_id') AS session_id,
               max(int_value) FILTER (WHERE param_name = 'ga_session_number') AS exported_number
        FROM prm GROUP BY ALL""",
    "evx": """
        SELECT e.user_pseudo_id, s.session_number, e.event_name, e.event_timestamp,
               make_timestamp(e.event_timestamp) AS event_datetime,
               e.event_date AS day_text, strptime(e.event_date, '%Y%m%d')::DATE AS event_date,
               h.page_location, h.page_title, h.page_referrer,
               h.traffic_source, h.traffic_medium, h.traffic_campaign, h.percent_scrolled,
               s.session_start, s.session_end,
               row_number() OVER (PARTITION BY e.user_pseudo_id, s.session_number
                                  ORDER BY e.event_timestamp NULLS FIRST, e.event_date, e.event_name) AS event_index
        FROM ev e
        LEFT JOIN shared h USING (user_pseudo_id, event_timestamp)
        LEFT JOIN ses s ON s.user_pseudo_id = e.user_pseudo_id
                       AND e.event_timestamp BETWEEN s.us0 AND s.us1""",
    "located": """
        SELECT sha256(lower(regexp_replace(page_location, '(\\?|#)[^\\n]*$', ''))) AS page_key,
               page_location, page_title, page_referrer,
               CASE WHEN regexp_matches(page_location, 'https?://[^/]+')
                    THEN regexp_extract(page_location, 'https?://([^/]+)', 1) END AS hostname,
               CASE WHEN regexp_matches(page_location, 'https?://[^/]+')
                    THEN regexp_extract(page_location, 'https?://[^/]+(.*)', 1) END AS page_path
        FROM shared WHERE page_location IS NOT NULL""",
    "pgs": """
        SELECT page_key, min(page_location) AS page_location, min(page_title) AS page_title,
               min(page_referrer) AS page_referrer, min(hostname) AS hostname,
               min(page_path) AS page_path
        FROM located GROUP BY page_key""",
    "pv": """
        SELECT x.user_pseudo_id, x.session_number,
               row_number() OVER (PARTITION BY x.user_pseudo_id, x.session_number
                                  ORDER BY x.event_timestamp, x.event_date) AS pageview_index,
               x.page_location, x.page_title, x.page_referrer, g.page_key,
               x.event_timestamp, x.event_datetime, x.event_date, x.session_start, x.session_end
        FROM evx x LEFT JOIN pgs g ON g.page_location = x.page_location
        WHERE x.event_name = 'page_view' AND x.session_number IS NOT NULL""",
    "land": """
        SELECT s.user_pseudo_id, s.session_number, s.session_start, s.session_end,
               v.page_location AS landing_page, v.page_title AS landing_page_title,
               v.page_referrer AS landing_page_referrer, v.event_datetime AS landing_datetime
        FROM ses s LEFT JOIN pv v ON v.user_pseudo_id = s.user_pseudo_id
             AND v.session_number = s.session_number AND v.pageview_index = 1""",
    "leave": """
        SELECT s.user_pseudo_id, s.session_number, s.session_start, s.session_end,
               v.page_location AS exit_page, v.page_title AS exit_page_title,
               v.page_referrer AS exit_page_referrer, v.event_datetime AS exit_datetime
        FROM ses s
        LEFT JOIN (SELECT * FROM pv QUALIFY row_number() OVER (
                       PARTITION BY user_pseudo_id, session_number ORDER BY pageview_index DESC) = 1) v
          ON v.user_pseudo_id = s.user_pseudo_id AND v.session_number = s.session_number""",
    "attrib": """
        SELECT s.user_pseudo_id, s.session_number, s.session_start, s.session_end,
               first(x.traffic_source ORDER BY x.event_timestamp, x.traffic_source)
                 FILTER (WHERE x.traffic_source IS NOT NULL) AS traffic_source,
               first(x.traffic_medium ORDER BY x.event_timestamp, x.traffic_medium)
                 FILTER (WHERE x.traffic_medium IS NOT NULL) AS traffic_medium,
               first(x.traffic_campaign ORDER BY x.event_timestamp, x.traffic_campaign)
                 FILTER (WHERE x.traffic_campaign IS NOT NULL) AS traffic_campaign
        FROM ses s
        LEFT JOIN evx x ON x.user_pseudo_id = s.user_pseudo_id
             AND x.event_timestamp BETWEEN s.us0 AND s.us1
        GROUP BY ALL""",
    "engage": """
        SELECT c.user_pseudo_id, c.session_number, c.total_events, c.total_pageviews,
               c.unique_pages_viewed, p.landing_page, p.exit_page,
               t.sessions_per_user, t.events_per_user
        FROM (SELECT user_pseudo_id, session_number, count(*) AS total_events,
                     count(*) FILTER (WHERE event_name = 'page_view') AS total_pageviews,
                     count(DISTINCT page_location) AS unique_pages_viewed
              FROM evx GROUP BY ALL) c
        LEFT JOIN (SELECT user_pseudo_id, session_number,
                          arg_min(page_location, pageview_index) AS landing_page,
                          arg_max(page_location, pageview_index) AS exit_page
                   FROM pv GROUP BY ALL) p USING (user_pseudo_id, session_number)
        LEFT JOIN (SELECT user_pseudo_id, count(DISTINCT session_number) AS sessions_per_user,
                          count(*) AS events_per_user
                   FROM evx GROUP BY ALL) t USING (user_pseudo_id)""",
    "sold": """
        SELECT x.user_pseudo_id, x.session_number, x.event_timestamp, x.event_datetime, x.event_name,
               x.event_date, x.page_location, i.item_id, i.item_name, i.item_brand, i.item_category,
               i.item_category2, i.item_category3, i.item_category4, i.item_variant,
               i.price, i.quantity, i.price * i.quantity AS item_value,
               CASE x.event_name WHEN 'purchase' THEN i.price * i.quantity ELSE 0.0::DOUBLE END AS item_revenue
        FROM itm i
        JOIN (SELECT DISTINCT ON (user_pseudo_id, event_timestamp, event_name) *
              FROM evx ORDER BY session_number, event_date) x
          ON x.user_pseudo_id = i.user_pseudo_id AND x.event_timestamp = i.event_timestamp""",
    "earned": """
        SELECT user_pseudo_id, session_number, sum(item_revenue) AS session_revenue
        FROM sold GROUP BY ALL""",
    "wide": """
        SELECT s.user_pseudo_id, s.session_number, s.session_start, s.session_end,
               s.session_duration_seconds,
               l.landing_page, l.landing_page_title, l.landing_page_referrer, l.landing_datetime,
               x.exit_page, x.exit_page_title, x.exit_page_referrer, x.exit_datetime,
               g.total_events, g.total_pageviews, g.unique_pages_viewed,
               g.sessions_per_user, g.events_per_user,
               a.traffic_source, a.traffic_medium, a.traffic_campaign, r.session_revenue
        FROM ses s
        LEFT JOIN land l USING (user_pseudo_id, session_number)
        LEFT JOIN leave x USING (user_pseudo_id, session_number)
        LEFT JOIN engage g USING (user_pseudo_id, session_number)
        LEFT JOIN attrib a USING (user_pseudo_id, session_number)
        LEFT JOIN earned r USING (user_pseudo_id, session_number)""",
    "daily": """
        SELECT d.event_date, d.daily_active_users, d.daily_sessions, d.daily_events,
               d.daily_pageviews, d.daily_revenue, l.landing_page AS top_landing_page,
               a.traffic_source AS top_traffic_source
        FROM (
            SELECT s.session_start::DATE AS event_date,
                   count(DISTINCT s.user_pseudo_id) AS daily_active_users,
                   count(DISTINCT s.user_pseudo_id || '-' || s.session_number) AS daily_sessions,
                   CAST(sum(coalesce(c.n, 0)) AS BIGINT) AS daily_events,
                   CAST(sum(coalesce(c.v, 0)) AS BIGINT) AS daily_pageviews,
                   round(sum(coalesce(r.money, 0.0)), 2) AS daily_revenue
            FROM ses s
            LEFT JOIN (SELECT user_pseudo_id, session_number, event_date, count(*) AS n,
                              count(*) FILTER (WHERE event_name = 'page_view') AS v
                       FROM evx GROUP BY ALL) c
              ON c.user_pseudo_id = s.user_pseudo_id AND c.session_number = s.session_number
             AND c.event_date = s.session_start::DATE
            LEFT JOIN (SELECT user_pseudo_id, session_number, event_date, sum(item_revenue) AS money
                       FROM sold GROUP BY ALL) r
              ON r.user_pseudo_id = s.user_pseudo_id AND r.session_number = s.session_number
             AND r.event_date = s.session_start::DATE
            GROUP BY 1) d
        LEFT JOIN (SELECT session_start::DATE AS event_date, landing_page, count(*) AS n
                   FROM land WHERE landing_page IS NOT NULL GROUP BY 1, 2
                   QUALIFY row_number() OVER (PARTITION BY session_start::DATE
                                              ORDER BY count(*) DESC, landing_page) = 1) l
          ON l.event_date = d.event_date
        LEFT JOIN (SELECT session_start::DATE AS event_date, traffic_source, count(*) AS n
                   FROM attrib WHERE traffic_source IS NOT NULL GROUP BY 1, 2
                   QUALIFY row_number() OVER (PARTITION BY session_start::DATE
                                              ORDER BY count(*) DESC, traffic_source) = 1) a
          ON a.event_date = d.event_date""",
    "paths": """
        SELECT user_pseudo_id, session_number, pageview_index, from_page, to_page,
               sha256(from_page) AS from_page_key, sha256(to_page) AS to_page_key
        FROM (SELECT user_pseudo_id, session_number, pageview_index, from_page,
                     lead(from_page) OVER (PARTITION BY user_pseudo_id, session_number
                                           ORDER BY pageview_index) AS to_page
              FROM (SELECT *, lower(regexp_replace(page_location, '(\\?|#)[^\\n]*$', '')) AS from_page
                    FROM pv))""",
    "reached": """
        SELECT x.user_pseudo_id, x.session_number, f.step_name, f.step_order,
               min(x.event_timestamp) AS step_timestamp,
               make_timestamp(min(x.event_timestamp)) AS step_datetime
        FROM evx x
        JOIN (VALUES ('view_product', 'view_item', 1::BIGINT), ('add_to_cart', 'add_to_cart', 2::BIGINT),
                     ('begin_checkout', 'begin_checkout', 3::BIGINT), ('purchase', 'purchase', 4::BIGINT))
             f(step_name, event_name, step_order) ON f.event_name = x.event_name
        WHERE x.session_number IS NOT NULL
        GROUP BY ALL""",
    "cal": """
        SELECT d::DATE AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day,
               dayofweek(d) + 1 AS day_of_week, CAST(strftime(d, '%U') AS BIGINT) AS week_of_year,
               dayname(d) AS day_name, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
               year(d) || '-Q' || quarter(d) AS year_quarter,
               dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
               date_trunc('month', d)::DATE AS month_start, last_day(d) AS month_end,
               date_trunc('quarter', d)::DATE AS quarter_start,
               (date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS quarter_end,
               date_trunc('year', d)::DATE AS year_start,
               (date_trunc('year', d) + INTERVAL 364 DAY)::DATE AS approx_year_end
        FROM (SELECT unnest(generate_series(
                  min(make_timestamp(us))::DATE, max(make_timestamp(us))::DATE, INTERVAL 1 DAY)) AS d
              FROM squeezed)""",
    "per_user": """
        SELECT w.user_pseudo_id, count(*) AS total_sessions,
               avg(date_diff('second', w.session_start, w.session_end)) AS avg_session_length_seconds,
               CAST(sum(w.total_events) AS BIGINT) AS total_events,
               CAST(sum(w.total_pageviews) AS BIGINT) AS total_pageviews,
               CAST(sum(w.unique_pages_viewed) AS BIGINT) AS total_unique_pages_viewed,
               round(sum(w.session_revenue), 2) AS total_revenue,
               round(avg(w.session_revenue), 6) AS avg_revenue_per_session,
               arg_min(w.traffic_source, w.session_number) AS first_traffic_source,
               arg_min(w.traffic_medium, w.session_number) AS first_traffic_medium,
               arg_min(w.traffic_campaign, w.session_number) AS first_traffic_campaign,
               arg_min(w.landing_page, w.session_number) AS first_landing_page
        FROM wide w GROUP BY w.user_pseudo_id""",
    "typed": """
        SELECT p.*, CASE WHEN from_page IS NULL THEN NULL
                         WHEN regexp_matches(from_page, '://blog\\.') THEN 'Support / Policies'
                         WHEN regexp_matches(from_page, '://m\\.') THEN 'Account'
                         WHEN regexp_matches(from_page, '://www\\.') THEN 'Home'
                         WHEN regexp_matches(from_page, '\\.html$') THEN 'Search'
                         WHEN regexp_matches(from_page, '/es/') THEN 'Wishlist'
                         WHEN regexp_matches(from_page, '/fr/') THEN 'Cart'
                         WHEN regexp_matches(from_page, '/de/') THEN 'Checkout'
                         WHEN regexp_matches(from_page, '/en/') THEN 'Browse / Product'
                         ELSE 'Other' END AS from_type
        FROM paths p""",
    "shown": """
        SELECT *, CASE WHEN traffic_source IS NULL OR trim(traffic_source) = '' THEN 'Unattributed'
                       WHEN traffic_source = '(direct)' THEN 'Direct'
                       WHEN traffic_source = '<Other>' THEN 'Other'
                       WHEN traffic_source = '(data deleted)' THEN 'Data deleted'
                       ELSE traffic_source END AS display_source
        FROM attrib""",
}

_MODE = """
    SELECT user_pseudo_id, {page} AS page FROM wide WHERE user_pseudo_id IS NOT NULL
    GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY user_pseudo_id
                               ORDER BY count(*) DESC, {page} ASC NULLS LAST) = 1"""



def _metric_rows() -> str:
    rows = [
        ("users", "yes_users", "no_users"),
        ("user_share", "yes_users / (yes_users + no_users)", "no_users / (yes_users + no_users)"),
        ("avg_sessions", "yes_s", "no_s"),
        ("avg_session_length_seconds", "yes_l", "no_l"),
        ("avg_pageviews", "yes_v", "no_v"),
        ("avg_unique_pages_viewed", "yes_u", "no_u"),
    ]
    union = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({y} AS DOUBLE) AS a, CAST({n} AS DOUBLE) AS b FROM split"
        for m, y, n in rows
    )
    averages = ", ".join(
        f"avg({c}) FILTER (WHERE bought) AS yes_{s}, avg({c}) FILTER (WHERE NOT bought) AS no_{s}"
        for s, c in [
            ("s", "total_sessions"),
            ("l", "avg_session_length_seconds"),
            ("v", "total_pageviews"),
            ("u", "total_unique_pages_viewed"),
        ]
    )
    return f"""
        SELECT metric, round(a, 6) AS purchasers, round(b, 6) AS non_purchasers, round(a / nullif(b, 0), 6) AS ratio
        FROM (WITH flagged AS (
                  SELECT u.*, u.user_pseudo_id IN (
                             SELECT user_pseudo_id FROM ev
                             WHERE event_name = 'purchase' AND user_pseudo_id IS NOT NULL) AS bought
                  FROM per_user u WHERE u.user_pseudo_id IS NOT NULL),
              split AS (
                  SELECT CAST(count(*) FILTER (WHERE bought) AS DOUBLE) AS yes_users,
                         CAST(count(*) FILTER (WHERE NOT bought) AS DOUBLE) AS no_users, {averages}
                  FROM flagged)
              {union})"""


FINAL: dict[str, str] = {
    "stg_event_params": """SELECT event_date, event_timestamp, event_name, user_pseudo_id,
                                  param_name, param_value FROM prm""",
    "stg_items": "SELECT * FROM itm",
    "stg_events": """SELECT e.event_date, e.event_timestamp, e.event_name, e.user_pseudo_id,
                            h.session_id, h.exported_number AS session_number
                     FROM ev e LEFT JOIN shared h USING (user_pseudo_id, event_timestamp)""",
    "stg_sessions": "SELECT * FROM numbered",
    "sessions": "SELECT * EXCLUDE (us0, us1) FROM ses",
    "events": """SELECT * EXCLUDE (day_text, traffic_source, traffic_medium, traffic_campaign,
                                   percent_scrolled) FROM evx""",
    "pageviews": "SELECT * FROM pv",
    "user_journey": """SELECT user_pseudo_id, session_number, event_index, event_name, event_timestamp,
                              event_datetime, day_text AS event_date, page_location, page_title,
                              session_start, session_end
                       FROM evx WHERE session_number IS NOT NULL""",
    "funnels": "SELECT * FROM reached",
    "landing_pages": "SELECT * FROM land",
    "exit_pages": "SELECT * FROM leave",
    "traffic_sources": """SELECT a.*, l.landing_page FROM attrib a
                          LEFT JOIN land l USING (user_pseudo_id, session_number)""",
    "engagement": "SELECT * FROM engage",
    "scroll_depth": """SELECT user_pseudo_id, session_number, event_timestamp, event_datetime,
                              day_text AS event_date, page_location, percent_scrolled
                       FROM evx WHERE event_name = 'scroll'""",
    "item_performance": "SELECT * FROM sold",
    "content_performance": """
        SELECT p.*, e.total_events, e.add_to_cart_events, e.purchases, i.total_revenue
        FROM (SELECT page_location, event_date, count(*) AS pageviews,
                     count(DISTINCT user_pseudo_id) AS unique_users,
                     count(DISTINCT session_number) AS sessions FROM pv GROUP BY ALL) p
        LEFT JOIN (SELECT page_location, event_date, count(*) AS total_events,
                          count(*) FILTER (WHERE event_name = 'add_to_cart') AS add_to_cart_events,
                          count(*) FILTER (WHERE event_name = 'purchase') AS purchases
                   FROM evx GROUP BY ALL) e
          ON e.page_location = p.page_location AND e.event_date = p.event_date
        LEFT JOIN (SELECT page_location, event_date, round(sum(item_revenue), 2) AS total_revenue
                   FROM sold GROUP BY ALL) i
          ON i.page_location = p.page_location AND i.event_date = p.event_date""",
    "daily_overview": "SELECT * FROM daily",
    "user_journey_paths": "SELECT * FROM paths",
    "session_summary": """SELECT * EXCLUDE (session_duration_seconds)
                                 REPLACE (round(session_revenue, 2) AS session_revenue) FROM wide""",
    "user_summary": f"""
        SELECT u.*, a.page AS most_common_landing_page, b.page AS most_common_exit_page
        FROM per_user u
        LEFT JOIN ({_MODE.format(page='landing_page')}) a ON a.user_pseudo_id = u.user_pseudo_id
        LEFT JOIN ({_MODE.format(page='exit_page')}) b ON b.user_pseudo_id = u.user_pseudo_id""",
    "dim_users": """SELECT user_pseudo_id, min(session_number) AS first_session_number,
                           min(session_start) AS first_session_start,
                           max(session_number) AS last_session_number,
                           max(session_end) AS last_session_end, count(*) AS total_sessions,
                           CAST(sum(session_duration_seconds) AS BIGINT) AS total_session_duration_seconds
                    FROM ses GROUP BY user_pseudo_id""",
    "dim_items": """SELECT sha256(item_id) AS item_key, item_id, min(item_name) AS item_name,
                           min(item_brand) AS item_brand, min(item_category) AS item_category,
                           min(item_category2) AS item_category2, min(item_category3) AS item_category3,
                           min(item_category4) AS item_category4, min(item_variant) AS item_variant,
                           min(price) AS default_price
                    FROM itm WHERE item_id IS NOT NULL GROUP BY item_id""",
    "dim_pages": "SELECT * FROM pgs",
    "calendar_days": """SELECT c.*, (SELECT count(*) FROM squeezed s WHERE make_timestamp(s.us)::DATE = c.date) AS events
                        FROM cal c""",
    "short_sessions": """
        SELECT user_pseudo_id, event_timestamp, event_name, event_date, session_number,
               min(event_timestamp) OVER (PARTITION BY user_pseudo_id, session_number) AS session_start,
               max(event_timestamp) OVER (PARTITION BY user_pseudo_id, session_number) AS session_end
        FROM (SELECT *, CAST(count(*) FILTER (WHERE earlier IS NULL OR event_timestamp - earlier >= 11 * 60000000)
                             OVER (PARTITION BY user_pseudo_id ORDER BY event_timestamp NULLS FIRST) AS BIGINT) AS session_number
              FROM gaps)""",
    "events_in_intervals": """
        SELECT e.user_pseudo_id, e.event_timestamp, e.event_name, e.event_date, s.session_number,
               s.session_start, s.session_end
        FROM ev e LEFT JOIN ses s ON s.user_pseudo_id = e.user_pseudo_id AND e.event_timestamp BETWEEN s.us0 AND s.us1""",
    "first_sources": """
        SELECT user_pseudo_id,
               first(traffic_source ORDER BY event_timestamp, traffic_source) FILTER (WHERE traffic_source IS NOT NULL) AS traffic_source,
               first(traffic_medium ORDER BY event_timestamp, traffic_medium) FILTER (WHERE traffic_medium IS NOT NULL) AS traffic_medium,
               first(traffic_campaign ORDER BY event_timestamp, traffic_campaign) FILTER (WHERE traffic_campaign IS NOT NULL) AS traffic_campaign
        FROM evx WHERE session_number IS NOT NULL GROUP BY user_pseudo_id""",
    "order_positions": """
        SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS ordered_at,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS position FROM orders""",
    "customer_orders": """
        SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
               arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price,
               arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order,
               arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price
        FROM orders GROUP BY o_custkey""",
    "supplier_favourites": """
        SELECT f.l_suppkey, f.l_returnflag AS usual_flag, p.l_partkey AS top_part
        FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS place
              FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)) f
        JOIN (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS place
              FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS n FROM lineitem GROUP BY ALL)) p USING (l_suppkey)
        WHERE f.place = 1 AND p.place = 1""",
    "priority_transitions": """
        SELECT o_orderpriority, next_priority, count(*) AS times
        FROM (SELECT o_orderpriority,
                     lead(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_priority
              FROM orders)
        WHERE next_priority IS NOT NULL GROUP BY ALL""",
    "kpi_totals": """SELECT (SELECT count(*) FROM ses) AS total_sessions,
                            (SELECT count(DISTINCT user_pseudo_id) FROM ses) AS total_users,
                            (SELECT count(*) FROM pv) AS total_pageviews,
                            (SELECT round(sum(item_revenue), 2) FROM sold) AS total_revenue""",
    "daily_trend": """SELECT c.date, c.year_month, c.year_quarter, d.daily_sessions, d.daily_revenue
                      FROM daily d JOIN cal c ON c.date = d.event_date""",
    "sessions_by_source": """SELECT display_source, count(*) AS sessions FROM shown
                             GROUP BY display_source""",
    "source_labels": """SELECT traffic_source, display_source, count(*) AS sessions FROM shown
                        GROUP BY ALL""",
    "sessions_by_landing_page": """SELECT landing_page, count(*) AS sessions FROM land
                                   GROUP BY landing_page""",
    "purchase_funnel": """
        SELECT step_order, step_name, sessions,
               CAST(sessions AS DOUBLE) / nullif(lag(sessions) OVER (ORDER BY step_order), 0) AS step_rate,
               CAST(sessions AS DOUBLE) / nullif(first_value(sessions) OVER (ORDER BY step_order), 0) AS overall_rate
        FROM (SELECT f.step_order, f.step_name, count(r.step_name) AS sessions
              FROM (VALUES ('view_product', 1::BIGINT), ('add_to_cart', 2::BIGINT), ('begin_checkout', 3::BIGINT),
                           ('purchase', 4::BIGINT)) f(step_name, step_order)
              LEFT JOIN reached r USING (step_order) GROUP BY ALL)""",
    "page_types": """
        SELECT g.page_key, g.page_location, t.from_type AS page_type
        FROM pgs g JOIN (SELECT DISTINCT from_page, from_type FROM typed_pages) t
          ON t.from_page = lower(regexp_replace(g.page_location, '(\\?|#)[^\\n]*$', ''))""",
    "page_type_transitions": """
        SELECT a.from_type AS from_page_type, b.from_type AS to_page_type, count(*) AS transitions
        FROM typed a JOIN typed b ON b.user_pseudo_id = a.user_pseudo_id
             AND b.session_number = a.session_number AND b.pageview_index = a.pageview_index + 1
        WHERE a.from_page IS NOT NULL AND b.from_page IS NOT NULL GROUP BY ALL""",
    "exit_rate_by_page_type": """
        SELECT from_type AS page_type, count(*) AS pageviews, count(*) FILTER (WHERE ends) AS exits,
               CAST(count(*) FILTER (WHERE ends) AS DOUBLE) / count(*) AS exit_rate
        FROM (SELECT *, pageview_index = max(pageview_index) OVER (
                            PARTITION BY user_pseudo_id, session_number) AS ends FROM typed)
        GROUP BY from_type""",
    "purchaser_comparison": _metric_rows(),
}
# the type rules again, over the page dimension
PARTS["typed_pages"] = PARTS["typed"].replace(
    "FROM paths p",
    "FROM (SELECT lower(regexp_replace(page_location, '(\\?|#)[^\\n]*$', '')) AS from_page FROM pgs) p",
)


def oracle(name: str) -> str:
    """The query with the parts it needs in front."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for part in PARTS:
            if part not in needed and re.search(rf"\b{part}\b", text):
                needed.add(part)
                visit(PARTS[part])

    visit(FINAL[name])
    chain = ",\n".join(f"{part} AS ({PARTS[part]})" for part in PARTS if part in needed)
    return f"WITH {chain}\n{FINAL[name]}" if chain else FINAL[name]
