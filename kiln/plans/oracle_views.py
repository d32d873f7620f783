"""The canonical views as DuckDB SQL, for the independent oracle.

Every definition mirrors ``kiln.sources.views``. Literals are cast to DOUBLE
where Spark uses a double literal, so both engines do the same IEEE
arithmetic. ``with_views(sql)`` prefixes a query with the WITH clause of the
views it names (and of the views those depend on).
"""

from __future__ import annotations

import re

VIEW_SQL: dict[str, str] = {
    "v_ratings_all": """
        SELECT user_id, item_id, arg_max(rating, event_id) AS rating
        FROM (SELECT user_id,
                     TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS item_id,
                     CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS DOUBLE) AS rating,
                     event_id
              FROM events)
        GROUP BY user_id, item_id""",
    "v_ratings_test": """
        SELECT * FROM v_ratings_all WHERE (user_id * 31 + item_id) % 5 = 0""",
    "v_ratings_train": """
        SELECT * FROM v_ratings_all
        WHERE (user_id * 31 + item_id) % 5 <> 0 AND user_id % 13 <> 0 AND item_id % 17 <> 0""",
    "v_incidents": """
        SELECT event_id AS incident_id,
               event_type AS category,
               'D' || CAST(user_id % 10 AS VARCHAR) AS district,
               ts,
               strftime(ts, '%m/%d/%Y') AS date_text,
               strftime(ts, '%H:%M') AS time_text,
               dayname(ts) AS day_of_week,
               CAST(-122.5 AS DOUBLE) + (user_id % 100) * CAST(0.002 AS DOUBLE) AS x,
               CAST(37.7 AS DOUBLE) + (event_id % 97) * CAST(0.002 AS DOUBLE) AS y,
               CASE WHEN event_type = 'signup' THEN ' ARREST'
                    WHEN event_id % 3 = 0 THEN 'NONE '
                    ELSE ' ARREST' END AS resolution
        FROM events""",
    "v_impressions": """
        SELECT event_id AS id,
               CAST(event_type IN ('click', 'purchase') AS INTEGER) AS click,
               strftime(ts, '%y%m%d%H') AS hour_code,
               user_id % 7 AS c1,
               event_id % 5 AS banner_pos,
               TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS site_id,
               's' || CAST(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 10 AS VARCHAR) AS site_category,
               user_id AS device_id,
               value
        FROM events""",
    "v_customers": """
        SELECT c_custkey AS customer_id,
               c_mktsegment AS segment,
               c_nationkey AS nation,
               CAST(coalesce(o.n, 0) AS BIGINT) AS n_orders,
               round(coalesce(o.s, CAST(0 AS DOUBLE)), 2) AS order_total,
               round(round(coalesce(o.s, CAST(0 AS DOUBLE)), 2) / nullif(coalesce(o.n, 0), 0), 4) AS avg_order,
               CAST(o.d AS DATE) AS first_order,
               (c_custkey * 7) % 73 AS tenure,
               CASE WHEN c_custkey % 50 = 0 THEN ' '
                    ELSE CAST(CAST(round(coalesce(o.s, CAST(0 AS DOUBLE)), 2) AS DECIMAL(18, 2)) AS VARCHAR)
               END AS total_charge,
               CASE WHEN c_acctbal < 0 THEN ' True.' ELSE ' False.' END AS churn_text,
               CAST(c_acctbal < 0 AS INTEGER) AS churned
        FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s, min(o_orderdate) AS d
                   FROM orders GROUP BY o_custkey) o
          ON c_custkey = o.o_custkey""",
    "v_comments": """
        SELECT doc_id AS comment_id, source AS creator_name, doc_id % 97 AS userid,
               lower(text) AS comment
        FROM documents""",
    "v_movies": """
        SELECT doc_id AS movie_id,
               1980 + doc_id % 40 AS year,
               'doc ' || CAST(doc_id AS VARCHAR) AS title,
               source AS origin,
               CASE WHEN doc_id % 11 = 0 THEN NULL ELSE concat_ws('/', lang, source) END AS genre,
               lang,
               text AS plot
        FROM documents""",
    "v_prices": """
        SELECT o_orderpriority AS name, CAST(o_orderdate AS DATE) AS date,
               round(avg(o_totalprice), 4) AS price
        FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)""",
    "v_points": """
        SELECT vec_id AS point_id,
               CAST(embedding[1] AS DOUBLE) AS x,
               CAST(embedding[2] AS DOUBLE) AS y,
               CAST(embedding AS DOUBLE[]) AS features,
               CAST(label AS BIGINT) AS label
        FROM embeddings""",
    "v_scored": """
        SELECT l.doc_id,
               CAST(l.quality AS BIGINT) AS label,
               (d.n_chars % 1000) / CAST(1000.0 AS DOUBLE) AS score,
               CAST((d.n_chars % 1000) / CAST(1000.0 AS DOUBLE) > 0.5 AS BIGINT) AS prediction
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
}

_NAME = re.compile(r"\bv_[a-z_]+\b")


def _deps(sql: str, seen: list[str]) -> None:
    for name in _NAME.findall(sql):
        if name in VIEW_SQL and name not in seen:
            _deps(VIEW_SQL[name], seen)
            seen.append(name)


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of every canonical view it uses."""
    names: list[str] = []
    _deps(sql, names)
    if not names:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n].strip()})" for n in names)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
