"""Independent SQL for every registered query, over the raw test tables.

Written the plain way (window over everything, ROW_NUMBER, NTILE): it states
what the answer is, not how to reach it at scale.
"""

from __future__ import annotations

import re

from tallyhall.sources import testviews as tv

# Blanks as Python's str.split() sees them, for RE2.
BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _values(rows: list[tuple]) -> str:
    def lit(x):
        return "'" + x + "'" if isinstance(x, str) else str(x)

    return "VALUES " + ", ".join("(" + ", ".join(lit(x) for x in row) + ")" for row in rows)


def _band(value: str, op: str, bands: list[tuple[object, str]], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {value} {op} {edge} THEN '{label}'" for edge, label in bands)
    return f"CASE {whens} ELSE {default} END"


def _mean(value: str) -> str:
    """From an exact sum of the values as they are written, read back as the nearest double."""
    return (
        f"CAST(CAST(sum(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE) / count({value})"
    )


def _pct(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) * 100 / nullif({whole}, 0)"


def _quantile(table: str, value: str, p: float, name: str, by: str = "") -> str:
    """Linear interpolation between the neighbours in sorted order."""
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
      SELECT {lead}CASE WHEN t < 0.5 THEN a + (b - a) * t ELSE b - (b - a) * (1 - t) END AS {name}
      FROM (SELECT {lead}max(v) FILTER (WHERE r = floor(pos)) AS a, max(v) FILTER (WHERE r = ceil(pos)) AS b,
                   max(pos - floor(pos)) AS t
            FROM (SELECT {lead}CAST({value} AS DOUBLE) AS v, row_number() OVER ({part} ORDER BY {value}) - 1 AS r,
                         CAST(count(*) OVER ({part}) - 1 AS DOUBLE) * CAST({p} AS DOUBLE) AS pos
                  FROM {table} WHERE {value} IS NOT NULL)
            {group})"""


def _taken() -> str:
    """Words with inside (a phrase holds it) and worth (of the phrase that begins here, else null)."""
    listed = [(p, len(p.split()), v) for p, v in tv.PHRASES.items()]
    return f"""
      phrase AS (SELECT col0 AS p, col1 AS n, CAST(col2 AS DOUBLE) AS worth FROM ({_values(listed)})),
      runs AS (
        SELECT key, pos, low, low || ' ' || lead(low, 1) OVER o AS r2,
               low || ' ' || lead(low, 1) OVER o || ' ' || lead(low, 2) OVER o AS r3,
               low || ' ' || lead(low, 1) OVER o || ' ' || lead(low, 2) OVER o || ' ' || lead(low, 3) OVER o AS r4
        FROM marked WINDOW o AS (PARTITION BY key ORDER BY pos)),
      matches AS (
        SELECT key, pos, n, worth FROM runs JOIN phrase ON p = r2 OR p = r3 OR p = r4),
      longest AS (SELECT key, pos, max(n) AS n FROM matches GROUP BY key, pos),
      picked AS (
        SELECT key, list_reduce(list([CAST(pos AS BIGINT), CAST(pos + n - 1 AS BIGINT)] ORDER BY pos),
                 lambda a, x: CASE WHEN x[1] > a[len(a)] THEN list_concat(a, x) ELSE a END) AS ends FROM longest GROUP BY key),
      spans AS (
        SELECT key, ends[2 * i + 1] AS first, ends[2 * i + 2] AS last
        FROM (SELECT key, ends, unnest(range(0, len(ends) // 2)) AS i FROM picked)),
      free AS (
        SELECT m.*, s.first IS NOT NULL AS inside, w.worth
        FROM marked m LEFT JOIN spans s ON m.key = s.key AND m.pos BETWEEN s.first AND s.last
        LEFT JOIN matches w ON m.key = w.key AND m.pos = w.pos AND m.pos = s.first AND w.n = s.last - s.first + 1),"""


def _in_context(rows: str, phrases: bool = False) -> str:
    """key, sentiment of rows (key, text): one row per word and windows over each text.

    Phrases are taken from left to right: a list of those found, ordered by first word and length, is reduced to
    those that begin behind the end of the last one taken.
    """
    words = lambda ws: ", ".join(f"'{w}'" for w in ws)
    ups = [w for w, k in tv.MODIFIERS.items() if k == 1]
    downs = [w for w, k in tv.MODIFIERS.items() if k == -1]
    nots = [w for w, k in tv.MODIFIERS.items() if k == 0]
    own = list(tv.LEXICON)
    marks = r"""!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~"""
    kind = (
        f"CASE WHEN low IN ({words(own)}) THEN 'own' WHEN low IN ({words(ups)}) THEN 'up' "
        f"WHEN low IN ({words(downs)}) THEN 'down' "
        f"WHEN low IN ({words(nots)}) OR contains(low, 'n''t') THEN 'not' END"
    )

    def step(v: str, k: str, caps: str, weight: float) -> str:
        up = f"CASE WHEN mixed AND {caps} THEN CAST(0.733 AS DOUBLE) ELSE 0 END"
        side = f"CASE WHEN {v} > 0 THEN CAST(1 AS DOUBLE) ELSE -1 END"
        return f"""CASE {k} WHEN 'up' THEN {v} + {side} * ((CAST(0.293 AS DOUBLE) + {up}) * CAST({weight} AS DOUBLE))
                            WHEN 'down' THEN {v} + {side} * ((-CAST(0.293 AS DOUBLE) + {up}) * CAST({weight} AS DOUBLE))
                            WHEN 'not' THEN {v} * CAST(-0.74 AS DOUBLE) ELSE {v} END"""

    return f"""
      WITH texts AS ({rows}),
      lists AS (
        SELECT key, list_filter(list_transform(string_split_regex(text, '[{BLANK}]+'),
                 lambda w: CASE WHEN length(trim(w, '{marks}')) <= 2 THEN w ELSE trim(w, '{marks}') END),
                 lambda w: w <> '') AS ws FROM texts),
      flat AS (SELECT key, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM lists),
      marked AS (SELECT *, lower(w) AS low, w = upper(w) AND w <> lower(w) AS caps FROM flat),
      {_taken() if phrases else ""}
      kinds AS (SELECT *, {"CASE WHEN inside THEN NULL ELSE " + kind + " END" if phrases else kind} AS kind FROM {"free" if phrases else "marked"}),
      seen AS (
        SELECT *, bool_or(caps) OVER d AND bool_or(NOT caps) OVER d AS mixed,
               min(CASE WHEN low = '{tv.CONTRAST}' THEN pos END) OVER d AS turn,
               lag(kind, 1) OVER o AS k1, lag(kind, 2) OVER o AS k2, lag(kind, 3) OVER o AS k3,
               lag(caps, 1) OVER o AS c1, lag(caps, 2) OVER o AS c2, lag(caps, 3) OVER o AS c3
        FROM kinds WINDOW d AS (PARTITION BY key), o AS (PARTITION BY key ORDER BY pos)),
      v0 AS (SELECT *, CAST(valence AS DOUBLE) + CASE WHEN mixed AND caps THEN
               CASE WHEN valence > 0 THEN CAST(0.733 AS DOUBLE) ELSE CAST(-0.733 AS DOUBLE) END ELSE 0 END AS a
             FROM {"(SELECT seen.*, CASE WHEN inside THEN worth ELSE valence END AS valence FROM seen LEFT JOIN lexicon ON low = token) WHERE valence IS NOT NULL" if phrases else "seen JOIN lexicon ON low = token"}),
      v1 AS (SELECT *, {step("a", "k1", "c1", 1.0)} AS b FROM v0),
      v2 AS (SELECT *, {step("b", "k2", "c2", 0.95)} AS c FROM v1),
      v3 AS (SELECT *, {step("c", "k3", "c3", 0.9)} AS d FROM v2),
      sums AS (
        SELECT key, CAST(sum(CAST(round(d * CASE WHEN pos < turn THEN CAST(0.5 AS DOUBLE)
                 WHEN pos > turn THEN CAST(1.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END * 100000000) AS BIGINT)) AS DOUBLE)
                 / 100000000 AS s
        FROM v3 GROUP BY key),
      marks AS (
        SELECT key, least(length(text) - length(replace(text, '!', '')), 4) * CAST(0.292 AS DOUBLE) AS e,
               length(text) - length(replace(text, '?', '')) AS q FROM texts),
      totals AS (
        SELECT key, coalesce(s, 0) + sign(coalesce(s, 0)) * (e + CASE WHEN q < 2 THEN 0
                 WHEN q <= 3 THEN q * CAST(0.18 AS DOUBLE) ELSE CAST(0.96 AS DOUBLE) END) AS v
        FROM marks LEFT JOIN sums USING (key))
      SELECT key, round(v / sqrt(v * v + 15), 6) AS sentiment FROM totals"""


LO, HI = tv.EVENT_WINDOW

CTES = {
    "behavior_raw": """
      SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'abc'
                  ELSE CAST(user_id * 20 + event_id % 20 AS VARCHAR) END AS user_id,
             json_extract_string(props, '$.k') AS item_id,
             CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS VARCHAR) AS category_id,
             CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav' WHEN 'signup' THEN 'cart'
                             WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior_type,
             CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS timestamp
      FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 50 = 0)""",
    "behavior_typed": f"""
      SELECT *, user_id IS NOT NULL AND item_id IS NOT NULL AND category_id IS NOT NULL
                AND ts IS NOT NULL AND behavior_type IS NOT NULL AS ok_fields,
             coalesce(behavior_type IN ('pv', 'fav', 'cart', 'buy'), false) AS ok_type,
             coalesce(ts BETWEEN {LO} AND {HI}, false) AS ok_time
      FROM (SELECT try_cast(user_id AS BIGINT) AS user_id, try_cast(item_id AS BIGINT) AS item_id,
                   try_cast(category_id AS BIGINT) AS category_id, behavior_type,
                   try_cast(timestamp AS BIGINT) AS ts FROM behavior_raw)""",
    "behavior": """
      SELECT user_id, item_id, category_id, behavior_type, dt AS datetime,
             strftime(dt, '%Y-%m-%d') AS date, CAST(extract(hour FROM dt) AS INTEGER) AS hour,
             CAST(isodow(dt) AS INTEGER) AS weekday
      FROM (SELECT *, make_timestamp(ts * 1000000) + INTERVAL 8 HOUR AS dt,
                   row_number() OVER (PARTITION BY user_id, item_id, behavior_type, ts
                                      ORDER BY category_id) AS rn
            FROM behavior_typed WHERE ok_fields AND ok_type AND ok_time)
      WHERE rn = 1""",
    "listings_raw": """
      SELECT o_orderkey AS id, o_custkey AS host_id, c_name AS host_name,
             CASE WHEN o_orderstatus = 'F' THEN 't' ELSE 'f' END AS host_is_superhost,
             CASE WHEN o_custkey % 40 = 0 THEN NULL WHEN o_custkey % 41 = 0 THEN '60'
                  WHEN o_custkey % 43 = 0 THEN '0' ELSE CAST(h.c AS VARCHAR) END AS host_listings_count,
             CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE n_name END AS neighbourhood_cleansed,
             CAST(22.3 AS DOUBLE) AS latitude, CAST(114.2 AS DOUBLE) AS longitude,
             c_mktsegment AS property_type, o_orderpriority AS room_type,
             coalesce(l.n, 0) + 1 AS accommodates,
             CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(coalesce(l.n, 0) AS DOUBLE) END AS bedrooms,
             CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(coalesce(l.n, 0) AS DOUBLE) END AS beds,
             CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN '$0.00'
                  ELSE '$' || format('{:,.2f}', o_totalprice) END AS price_text,
             o_orderkey % 30 + 1 AS minimum_nights,
             coalesce(l.n, 0) AS number_of_reviews, coalesce(l.n, 0) AS number_of_reviews_ltm,
             l.rt AS review_scores_rating, o_orderkey % 366 AS availability_365,
             coalesce(l.rev, CAST(0 AS DOUBLE)) AS estimated_revenue_l365d,
             CAST(l.first AS DATE) AS first_review, CAST(l.last AS DATE) AS last_review,
             CASE WHEN o_orderstatus = 'O' THEN 't' ELSE 'f' END AS instant_bookable
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN (SELECT o_custkey AS k, count(*) AS c FROM orders GROUP BY o_custkey) h ON h.k = o_custkey
      LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n,
                        CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 10 AS rt,
                        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS rev,
                        min(l_shipdate) AS first, max(l_shipdate) AS last
                 FROM lineitem GROUP BY l_orderkey) l ON l.k = o_orderkey""",
    "priced": """
      SELECT * FROM (SELECT *, try_cast(trim(regexp_replace(price_text, '[$,]', '', 'g')) AS DOUBLE) AS price
                     FROM listings_raw)
      WHERE price > 0""",
    "cap": _quantile("priced", "price", 0.99, "p99"),
    "listings": f"""
      SELECT * EXCLUDE (price_text, host_listings_count, hlc),
             least(price, (SELECT p99 FROM cap)) AS price_winsor,
             round(1 - availability_365 / CAST(365 AS DOUBLE), 4) AS occupancy_ratio,
             hlc AS host_listings_count,
             CASE WHEN hlc <= 0 THEN NULL ELSE
               {_band("hlc", "<=", [(2, "个人(1-2)"), (10, "小型(3-10)"), (50, "专业(11-50)"), (1000000, "机构(50+)")])}
             END AS host_scale
      FROM (SELECT *, coalesce(try_cast(host_listings_count AS DOUBLE), 1) AS hlc FROM priced
            WHERE neighbourhood_cleansed IS NOT NULL AND room_type IS NOT NULL AND host_id IS NOT NULL)""",
    "listing_reviews_raw": """
      SELECT l_orderkey AS listing_id, l_orderkey * 10 + l_linenumber AS id,
             strftime(l_shipdate, '%Y-%m-%d') AS date,
             CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE l_returnflag || ' ' || l_linestatus END AS comments
      FROM lineitem""",
    "listing_reviews": """
      SELECT listing_id, id, CAST(date AS DATE) AS date, comments, CAST(length(comments) AS INTEGER) AS review_len
      FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY listing_id, date, length(comments), comments) AS rn
            FROM listing_reviews_raw
            WHERE comments IS NOT NULL AND length(comments) > 0 AND comments NOT IN ('nan', 'None'))
      WHERE rn = 1 AND date IS NOT NULL""",
    "lexicon": f"SELECT col0 AS token, CAST(col1 AS DECIMAL(4,1)) AS valence FROM ({_values(list(tv.LEXICON.items()))})",
    "reviews_raw": """
      SELECT source AS business_id, 'shop ' || source AS business_name,
             CASE WHEN doc_id % 89 = 0 THEN '31/02/2020'
                  ELSE '"' || strftime(DATE '2020-01-01' + CAST(doc_id % 1500 AS INTEGER), '%d/%m/%Y') || '"' END AS "Date",
             CAST(doc_id % 7 AS VARCHAR) AS "Rating",
             CASE WHEN doc_id % 83 = 0 THEN NULL ELSE text END AS "Content",
             CASE WHEN quality = 1 THEN 'Elite' END AS "Eelite_status",
             CASE WHEN toxic = 0 THEN lang END AS "Reactions"
      FROM documents LEFT JOIN labels USING (doc_id)""",
    "reviews_typed": """
      SELECT * REPLACE (CAST(try_strptime(trim(replace("Date", '"', '')), '%d/%m/%Y') AS DATE) AS "Date",
                        try_cast("Rating" AS DOUBLE) AS "Rating")
      FROM reviews_raw""",
    "reviews_kept": f"""
      SELECT row_number() OVER () AS rid, business_id, business_name, "Date", "Rating", "Content", "Reactions",
             CAST(length("Content") AS INTEGER) AS review_len,
             CAST(len(regexp_extract_all("Content", '[^{BLANK}]+')) AS INTEGER) AS word_count, elite_flag
      FROM (SELECT *, row_number() OVER (PARTITION BY business_id, "Content"
                 ORDER BY "Date", "Rating", business_name NULLS FIRST, elite_flag, "Reactions" NULLS FIRST) AS rn
            FROM (SELECT *, CASE WHEN "Eelite_status" IS NULL THEN 0 ELSE 1 END AS elite_flag FROM reviews_typed)
            WHERE "Date" IS NOT NULL AND "Rating" BETWEEN 1 AND 5 AND length("Content") > 0)
      WHERE rn = 1""",
    "reviews": """
      SELECT business_id, business_name, "Date", "Rating", review_len, word_count, elite_flag, sentiment,
             CASE WHEN sentiment <= -0.05 THEN '负面' WHEN sentiment <= 0.05 THEN '中性' ELSE '正面' END AS sentiment_label,
             "Reactions"
      FROM reviews_kept JOIN review_scores ON rid = key""",
    "comments_raw": """
      SELECT 'c' || conv_id || '-' || turn AS comment_id,
             CASE WHEN (conv_id * 10 + turn) % 23 = 0 THEN '[deleted]'
                  WHEN (conv_id * 10 + turn) % 29 = 0 THEN '[removed]'
                  WHEN turn = 1 AND conv_id % 31 = 0 THEN 'short' ELSE text END AS comment_body
      FROM conversations
      UNION ALL SELECT 'd' || doc_id, text FROM documents
      UNION ALL SELECT 'd' || doc_id, text FROM documents WHERE doc_id % 50 = 0""",
    "comments_live": """
      SELECT comment_id, comment_body AS body, CAST(length(comment_body) AS INTEGER) AS review_len
      FROM comments_raw
      WHERE comment_body IS NOT NULL AND comment_body NOT IN ('[deleted]', '[removed]', 'nan')""",
    "comments_unique": """
      SELECT comment_id, body, review_len
      FROM (SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY review_len DESC,
                 sha256(length(comment_id) || ':' || comment_id || body)) AS rn FROM comments_live)
      WHERE rn = 1""",
    "comments": """
      SELECT comment_id, body, sentiment,
             CASE WHEN sentiment <= -0.05 THEN '负面' WHEN sentiment <= 0.05 THEN '中性' ELSE '正面' END AS sentiment_label,
             review_len
      FROM comments_unique JOIN comment_scores ON comment_id = key WHERE review_len >= 15""",
}

NEGATIVE = "sentiment_label = '负面'"
PV, BUY = "behavior_type = 'pv'", "behavior_type = 'buy'"


def _topics() -> str:
    parts = []
    for name, words in tv.TOPICS.items():
        hit = " OR ".join(f"contains(lower(body), '{w}')" for w in words)
        parts.append(
            f'SELECT \'{name}\' AS "痛点主题", count(*) FILTER (WHERE {hit}) AS "提及数" '
            "FROM comments_unique WHERE review_len >= 15"
        )
    return " UNION ALL ".join(parts)


def _conversion(grain: str) -> str:
    did = ", ".join(f"bool_or(behavior_type = '{k}') AS {k}" for k in ("fav", "cart", "buy"))
    return f"""
      SELECT {_pct("count(*) FILTER (WHERE fav AND buy)", "count(*) FILTER (WHERE fav)")} AS "收藏转购买率pct",
             {_pct("count(*) FILTER (WHERE cart AND buy)", "count(*) FILTER (WHERE cart)")} AS "加购转购买率pct"
      FROM (SELECT {did} FROM behavior GROUP BY {grain})"""


QUESTIONS = {
    "tb_overview": """
      SELECT count(*) AS "行为总量", count(DISTINCT user_id) AS "活跃用户数",
             count(DISTINCT item_id) AS "触达商品数", count(DISTINCT category_id) AS "触达类目数" FROM behavior""",
    "tb_funnel": """
      SELECT s.col1 AS "漏斗层级", count(DISTINCT user_id) AS "用户数"
      FROM (VALUES ('pv', '浏览pv'), ('fav', '收藏fav'), ('cart', '加购cart'), ('buy', '购买buy')) s
      LEFT JOIN behavior ON behavior_type = s.col0 GROUP BY s.col1""",
    "tb_hourly": f"""
      SELECT hour AS "小时", count(*) FILTER (WHERE {PV}) AS "pv量", count(*) FILTER (WHERE {BUY}) AS "购买量"
      FROM behavior GROUP BY hour""",
    "tb_daily": f"""
      SELECT date AS "日期", count(DISTINCT user_id) AS "活跃用户数", count(*) FILTER (WHERE {PV}) AS "pv量",
             {_pct(f"count(*) FILTER (WHERE {BUY})", f"count(*) FILTER (WHERE {PV})")} AS "购买转化率pct"
      FROM behavior GROUP BY date""",
    "tb_category": f"""
      SELECT category_id AS "类目ID", count(*) FILTER (WHERE {PV}) AS "浏览量",
             count(*) FILTER (WHERE {BUY}) AS "购买量",
             {_pct(f"count(*) FILTER (WHERE {BUY})", f"count(*) FILTER (WHERE {PV})")} AS "购买转化率pct"
      FROM behavior GROUP BY category_id HAVING count(*) FILTER (WHERE {PV}) >= {tv.MIN_CATEGORY_VIEWS}""",
    "tb_category_top_conv": """
      SELECT "类目ID", "购买转化率pct", "浏览量" FROM (@tb_category@)
      ORDER BY "购买转化率pct" DESC, "浏览量" DESC, "类目ID" LIMIT 10""",
    "tb_repurchase": f"""
      SELECT band AS "购买频次分层", count(*) AS "用户数",
             {_pct("count(*)", "sum(count(*)) OVER ()")} AS "占比pct"
      FROM (SELECT {_band("count(*)", "<=", [(1, "1次"), (2, "2次"), (5, "3-5次")], "'6次及以上'")} AS band
            FROM behavior WHERE {BUY} GROUP BY user_id)
      GROUP BY band""",
    "tb_user_activity_tier": f"""
      SELECT 'D' || tile AS "活跃度分层", count(*) AS "用户数",
             {_pct("sum(n)", "sum(sum(n)) OVER ()")} AS "行为量占比pct"
      FROM (SELECT n, ntile(10) OVER (ORDER BY n, user_id) AS tile
            FROM (SELECT user_id, count(*) AS n FROM behavior GROUP BY user_id))
      GROUP BY tile""",
    "tb_buyer_vs_nonbuyer": f"""
      SELECT CASE WHEN buyer THEN '购买用户' ELSE '未购买用户' END AS "用户群",
             CAST(sum(n) AS DOUBLE) / count(*) AS "平均行为次数", CAST(sum(items) AS DOUBLE) / count(*) AS "平均触达商品数"
      FROM (SELECT bool_or({BUY}) AS buyer, count(*) AS n, count(DISTINCT item_id) AS items FROM behavior GROUP BY user_id)
      GROUP BY buyer""",
    "tb_intermediate_conv": _conversion("user_id"),
    "recall_window": f"""
      SELECT "行为", "等待天数", "次数", {_pct('"次数"', 'sum("次数") OVER (PARTITION BY "行为")')} AS "占比pct"
      FROM (SELECT behavior_type AS "行为", CAST(CAST(bought AS DATE) - CAST(datetime AS DATE) AS INTEGER) AS "等待天数", count(*) AS "次数"
            FROM (SELECT *, min(CASE WHEN behavior_type = 'buy' THEN datetime END) OVER (
                    PARTITION BY user_id, item_id ORDER BY datetime RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bought
                  FROM behavior)
            WHERE behavior_type IN ('fav', 'cart') GROUP BY ALL)""",
    "browsing_path": """
      WITH timed AS (SELECT user_id, CAST(epoch(datetime) AS BIGINT) AS t, behavior_type = 'buy' AS buy FROM behavior),
      flagged AS (SELECT *, CASE WHEN coalesce(t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= 1800, false) THEN 0 ELSE 1 END AS fresh FROM timed),
      numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS s FROM flagged),
      cut AS (SELECT *, (t - min(t) OVER (PARTITION BY user_id, s)) // 43200 AS part FROM numbered),
      firsts AS (SELECT *, min(CASE WHEN buy THEN t END) OVER (PARTITION BY user_id, s, part) AS first_buy FROM cut),
      parts AS (
        SELECT user_id, s, part, count(*) AS steps, max(first_buy) AS first_buy, count(*) FILTER (WHERE t < first_buy) AS earlier
        FROM firsts GROUP BY ALL)
      SELECT CASE WHEN first_buy IS NULL THEN '未购买' ELSE '购买' END AS "会话结果", count(*) AS "会话数",
             CAST(sum(steps) AS DOUBLE) / count(*) AS "平均步数",
             CAST(sum(CASE WHEN first_buy IS NOT NULL THEN earlier END) AS DOUBLE) / count(first_buy) AS "首购前平均步数"
      FROM parts GROUP BY 1""",
    "goods_viewed_together": f"""
      WITH views AS (SELECT DISTINCT user_id, item_id FROM behavior WHERE {PV} AND user_id IS NOT NULL AND item_id IS NOT NULL),
      sizes AS (SELECT item_id, count(*) AS n FROM views GROUP BY item_id),
      pairs AS (SELECT a.item_id AS a, b.item_id AS b, count(*) AS n
                FROM views a JOIN views b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY ALL HAVING count(*) >= 2)
      SELECT a AS "商品A", b AS "商品B", p.n AS "共同浏览用户数",
             CAST(p.n AS DOUBLE) * (SELECT count(DISTINCT user_id) FROM views) / (CAST(x.n AS DOUBLE) * y.n) AS "提升度"
      FROM pairs p JOIN sizes x ON x.item_id = a JOIN sizes y ON y.item_id = b
      ORDER BY "提升度" DESC, "共同浏览用户数" DESC, "商品A", "商品B" LIMIT 20""",
    "rfm_segments": f"""
      SELECT CASE WHEN r >= 4 AND f >= 4 THEN '重要价值' WHEN r >= 4 THEN '新近' WHEN f >= 4 THEN '重要唤回'
                  ELSE '流失风险' END AS segment,
             count(*) AS users, CAST(sum(recency) AS DOUBLE) / count(*) AS avg_recency_days,
             CAST(sum(frequency) AS DOUBLE) / count(*) AS avg_frequency
      FROM (SELECT *, ntile(5) OVER (ORDER BY recency DESC, md5(CAST(user_id AS VARCHAR))) AS r,
                   ntile(5) OVER (ORDER BY frequency, md5(CAST(user_id AS VARCHAR))) AS f
            FROM (SELECT user_id, count(*) AS frequency,
                         (SELECT CAST(max(date) AS DATE) FROM behavior) - CAST(max(date) AS DATE) AS recency
                  FROM behavior WHERE {BUY} GROUP BY user_id))
      GROUP BY 1""",
    "top_items_per_category": f"""
      SELECT category_id, item_id, views, CAST(rank AS INTEGER) AS rank
      FROM (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY views DESC, item_id) AS rank
            FROM (SELECT category_id, item_id, count(*) AS views FROM behavior WHERE {PV} GROUP BY ALL))
      WHERE rank <= 3""",
    "retention_by_day": f"""
      WITH firsts AS (SELECT user_id, min(date) AS cohort FROM behavior GROUP BY user_id),
           counts AS (SELECT cohort, CAST(CAST(date AS DATE) - CAST(cohort AS DATE) AS INTEGER) AS day_offset,
                             count(DISTINCT user_id) AS users
                      FROM behavior JOIN firsts USING (user_id) GROUP BY ALL)
      SELECT c.*, {_pct("c.users", "z.users")} AS retention_pct
      FROM counts c JOIN counts z ON c.cohort = z.cohort AND z.day_offset = 0""",
    "ab_neighbourhood": f"""
      SELECT neighbourhood_cleansed AS "区域", count(*) AS "房源数", {_mean("price_winsor")} AS "均价",
             {_mean("occupancy_ratio")} * 100 AS "供给紧张度pct"
      FROM listings GROUP BY 1""",
    "ab_room_type": f"""
      SELECT room_type AS "房型", count(*) AS "房源数", {_mean("price_winsor")} AS "均价",
             {_pct("count(*)", "sum(count(*)) OVER ()")} AS "供给占比pct"
      FROM listings GROUP BY 1""",
    "ab_price_by_rating": f"""
      SELECT CASE WHEN review_scores_rating IS NULL THEN '无评分' ELSE
               {_band("review_scores_rating", "<", [(4.0, "4.0以下"), (4.5, "4.0-4.5"), (4.8, "4.5-4.8")], "'4.8-5.0'")}
             END AS "评分档", {_mean("price_winsor")} AS "均价", count(*) AS "房源数"
      FROM listings GROUP BY 1""",
    "ab_price_by_reviews": f"""
      SELECT {_band("number_of_reviews", "<=", [(0, "0条"), (10, "1-10条"), (50, "11-50条"), (200, "51-200条")], "'200条以上'")}
               AS "评论数档", {_mean("price_winsor")} AS "均价", count(*) AS "房源数"
      FROM listings GROUP BY 1""",
    "ab_host_scale": f"""
      SELECT host_scale AS "房东规模", count(DISTINCT host_id) AS "房东数",
             {_pct("count(*)", "sum(count(*)) OVER ()")} AS "房源占比pct",
             {_mean("estimated_revenue_l365d")} AS "房均年化收入"
      FROM listings GROUP BY 1""",
    "ab_host_concentration": f"""
      SELECT {_pct("sum(n) FILTER (WHERE tile = 1)", "sum(n)")} AS "头部10%房东房源占比pct"
      FROM (SELECT n, ntile(10) OVER (ORDER BY n DESC, host_id) AS tile
            FROM (SELECT host_id, count(*) AS n FROM listings GROUP BY host_id))""",
    "ab_superhost_premium": f"""
      SELECT CASE WHEN host_is_superhost = 't' THEN 1 ELSE 0 END AS "超级房东", {_mean("price_winsor")} AS "均价",
             {_mean("estimated_revenue_l365d")} AS "年化预估收入"
      FROM listings GROUP BY 1""",
    "ab_top_revenue_profile": f"""
      SELECT CASE WHEN tile = 1 THEN 'Top25%(高收入)' ELSE '其余75%' END AS "收入分层",
             {_mean("price_winsor")} AS "均价", {_mean("review_scores_rating")} AS "平均评分",
             {_mean("accommodates")} AS "平均可住人数"
      FROM (SELECT *, ntile(4) OVER (ORDER BY estimated_revenue_l365d DESC NULLS LAST, md5(CAST(id AS VARCHAR))) AS tile
            FROM listings)
      GROUP BY 1""",
    "ab_review_month_of_year": f"""
      SELECT m AS "月份", CAST(sum(n) AS DOUBLE) / count(*) AS "年均月评论量"
      FROM (SELECT CAST(year(date) AS INTEGER) AS y, CAST(month(date) AS INTEGER) AS m, count(*) AS n
            FROM listing_reviews WHERE date >= DATE '{tv.SEASON_START}' GROUP BY ALL)
      GROUP BY m""",
    "listing_review_activity": f"""
      SELECT neighbourhood_cleansed AS "区域", count(*) AS "房源数", count(written) AS "有评论房源数",
             CAST(coalesce(sum(written), 0) AS BIGINT) AS "评论总量", {_pct("count(written)", "count(*)")} AS "有评论占比pct"
      FROM (SELECT l.*, (SELECT nullif(count(*), 0) FROM listing_reviews r WHERE r.listing_id = l.id) AS written FROM listings l)
      GROUP BY 1""",
    "season_lead": f"""
      WITH months AS (SELECT listing_id, year(date) * 12 + month(date) AS m FROM listing_reviews),
      firsts AS (SELECT listing_id, min(m) AS m FROM months GROUP BY listing_id),
      edges AS (SELECT min(m) AS a, max(m) AS z FROM months WHERE m >= year(DATE '{tv.SEASON_START}') * 12 + month(DATE '{tv.SEASON_START}')),
      series AS (
        SELECT m, (SELECT count(*) FROM firsts f WHERE f.m = c.m) AS x, (SELECT count(*) FROM months o WHERE o.m = c.m) AS y
        FROM (SELECT unnest(range(a, z + 1)) AS m FROM edges) c),
      pairs AS (SELECT CAST(lag AS INTEGER) AS lag, CAST(s.x AS HUGEINT) AS x, CAST(t.y AS HUGEINT) AS y
                FROM series s, range(0, 7) l(lag), series t WHERE t.m = s.m + lag)
      SELECT lag AS "提前月数", count(*) AS "月份数",
             CAST(count(*) * sum(x * y) - sum(x) * sum(y) AS DOUBLE)
               / nullif(sqrt(CAST(count(*) * sum(x * x) - sum(x) * sum(x) AS DOUBLE))
                        * sqrt(CAST(count(*) * sum(y * y) - sum(y) * sum(y) AS DOUBLE)), 0) AS "相关系数"
      FROM pairs GROUP BY lag""",
    "yp_rating_dist": f"""
      SELECT "Rating" AS "星级", count(*) AS "评论数", {_mean("sentiment")} AS "平均情感得分",
             {_mean("word_count")} AS "平均词数", {_pct("count(*)", "sum(count(*)) OVER ()")} AS "占比pct"
      FROM reviews GROUP BY 1""",
    "yp_elite_vs_normal": f"""
      SELECT CASE WHEN elite_flag = 1 THEN '精英用户' ELSE '普通用户' END AS "用户类型", count(*) AS "评论数",
             {_mean('"Rating"')} AS "平均星级", {_mean("word_count")} AS "平均词数",
             {_mean("sentiment")} AS "平均情感得分"
      FROM reviews GROUP BY 1""",
    "sentiment_quantiles": "SELECT * FROM "
    + " JOIN ".join(
        f"({_quantile('reviews_rated', 'sentiment', p, name, 'rating')}) AS {name}_" + (" USING (rating)" if i else "")
        for i, (name, p) in enumerate({"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}.items())
    ),
    "rd_sentiment_dist": f"""
      SELECT sentiment_label AS "情感标签", count(*) AS "评论数",
             {_pct("count(*)", "sum(count(*)) OVER ()")} AS "占比pct"
      FROM comments GROUP BY 1""",
    "rd_len_vs_sentiment": f"""
      SELECT {_band("review_len", "<", [(50, "50字以下"), (150, "50-150字"), (300, "150-300字")], "'300字以上'")} AS "评论长度档",
             count(*) AS "评论数", {_pct(f"count(*) FILTER (WHERE {NEGATIVE})", "count(*)")} AS "负面占比pct"
      FROM comments GROUP BY 1""",
    "rd_pain_points": _topics(),
}
CTES["review_scores"] = _in_context('SELECT rid AS key, "Content" AS text FROM reviews_kept')
CTES["comment_scores"] = _in_context("SELECT comment_id AS key, body AS text FROM comments_unique")
CTES["reviews_rated"] = 'SELECT "Rating" AS rating, sentiment FROM reviews'

BEHAVIOR_SUMMARY = """
  SELECT count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
         count(DISTINCT category_id) AS categories, min(date) AS date_min, max(date) AS date_max FROM behavior"""
COMMENTS_SUMMARY = f"""
  SELECT count(*) AS rows, CAST(count(*) FILTER (WHERE {NEGATIVE}) AS DOUBLE) / count(*) AS neg_ratio FROM comments"""

REPORT = """
  SELECT CAST(seq AS INTEGER) AS seq, d AS "数据集", s AS "步骤", a AS "清洗动作", n AS "剩余记录数" FROM (
    WITH b AS (SELECT count(*) AS n0, count(*) FILTER (WHERE ok_fields) AS n1,
                      count(*) FILTER (WHERE ok_fields AND ok_type) AS n2,
                      count(*) FILTER (WHERE ok_fields AND ok_type AND ok_time) AS n3,
                      (SELECT count(*) FROM behavior) AS n4 FROM behavior_typed),
         l AS (SELECT (SELECT count(*) FROM listings_raw) AS n0, (SELECT count(*) FROM priced) AS n1,
                      (SELECT count(*) FROM listings) AS n2, (SELECT p99 FROM cap) AS p99),
         v AS (SELECT (SELECT count(*) FROM listing_reviews_raw) AS n0,
                      (SELECT count(*) FROM listing_reviews_raw WHERE comments IS NOT NULL) AS n1,
                      (SELECT count(*) FROM listing_reviews) AS n2),
         r AS (SELECT count(*) AS n0, count("Date") AS n1,
                      count(*) FILTER (WHERE "Date" IS NOT NULL AND "Rating" BETWEEN 1 AND 5) AS n2,
                      (SELECT count(*) FROM reviews_kept) AS n3 FROM reviews_typed),
         c AS (SELECT (SELECT count(*) FROM comments_raw) AS n0, (SELECT count(*) FROM comments_live) AS n1,
                      (SELECT count(*) FROM comments_unique) AS n2,
                      (SELECT count(*) FROM comments_unique WHERE review_len >= 15) AS n3)
    SELECT 1 AS seq, '淘宝用户行为(天池)' AS d, '原始数据' AS s, '共 ' || n0 || ' 条用户行为记录' AS a, n0 AS n FROM b
    UNION ALL SELECT 2, '淘宝用户行为(天池)', '缺失值处理', '剔除字段缺失/非数值的脏记录', n1 FROM b
    UNION ALL SELECT 3, '淘宝用户行为(天池)', '异常值过滤', '剔除非法行为类型', n2 FROM b
    UNION ALL SELECT 4, '淘宝用户行为(天池)', '异常值过滤', '剔除官方时间窗口外的记录', n3 FROM b
    UNION ALL SELECT 5, '淘宝用户行为(天池)', '去重', '剔除完全重复记录 ' || (n3 - n4) || ' 条', n4 FROM b
    UNION ALL SELECT 6, '淘宝用户行为(天池)', '缺失值处理', '剔除关键字段缺失记录', n4 FROM b
    UNION ALL SELECT 7, '香港Airbnb(InsideAirbnb)', '原始数据', '共 ' || n0 || ' 条香港房源', n0 FROM l
    UNION ALL SELECT 8, '香港Airbnb(InsideAirbnb)', '异常值过滤', '剔除价格缺失或<=0的房源', n1 FROM l
    UNION ALL SELECT 9, '香港Airbnb(InsideAirbnb)', '极端值缩尾', '价格99分位=$' || CAST(round(p99) AS BIGINT) || ' 以上封顶处理', n1 FROM l
    UNION ALL SELECT 10, '香港Airbnb(InsideAirbnb)', '缺失值处理', '剔除区域/房型/房东缺失的房源', n2 FROM l
    UNION ALL SELECT 11, '香港Airbnb(InsideAirbnb)', '原始数据', '共 ' || n0 || ' 条评论', n0 FROM v
    UNION ALL SELECT 12, '香港Airbnb(InsideAirbnb)', '缺失值处理', '剔除空评论', n1 FROM v
    UNION ALL SELECT 13, '香港Airbnb(InsideAirbnb)', '去重', '剔除重复评论', n2 FROM v
    UNION ALL SELECT 14, 'Yelp评论样本', '原始数据', '共 ' || n0 || ' 条商家评论', n0 FROM r
    UNION ALL SELECT 15, 'Yelp评论样本', '类型转换', '标准化DD/MM/YYYY日期并剔除无法解析的日期', n1 FROM r
    UNION ALL SELECT 16, 'Yelp评论样本', '异常值过滤', '剔除非1-5星评分', n2 FROM r
    UNION ALL SELECT 17, 'Yelp评论样本', '去重/缺失值', '剔除重复与空评论', n3 FROM r
    UNION ALL SELECT 18, 'Reddit(r/ChatGPT)', '原始数据', '共 ' || n0 || ' 条社区评论', n0 FROM c
    UNION ALL SELECT 19, 'Reddit(r/ChatGPT)', '缺失值处理', '剔除已删除/移除的评论', n1 FROM c
    UNION ALL SELECT 20, 'Reddit(r/ChatGPT)', '去重', '剔除重复评论', n2 FROM c
    UNION ALL SELECT 21, 'Reddit(r/ChatGPT)', '异常值过滤', '剔除<15字符的灌水评论', n3 FROM c)"""

SCORED_DOCS = """
  SELECT doc_id, coalesce(v, 0) / sqrt(coalesce(v, 0) * coalesce(v, 0) + 15) AS sentiment
  FROM documents LEFT JOIN
       (SELECT doc_id, CAST(sum(valence) AS DOUBLE) AS v
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents)
        JOIN lexicon USING (token) GROUP BY doc_id) USING (doc_id)"""


def _one(question: str, column: str, where: str = "true") -> str:
    return f"(SELECT max({column}) FROM (@{question}@) WHERE {where})"


def _ratio(question: str, column: str, top: str, bottom: str) -> str:
    return f"{_one(question, column, top)} / {_one(question, column, bottom)}"


def _headline() -> str:
    stage = lambda name: _one("tb_funnel", '"用户数"', f"\"漏斗层级\" = '{name}'")
    buyers, others = "\"用户群\" = '购买用户'", "\"用户群\" = '未购买用户'"
    sup, reg = '"超级房东" = 1', '"超级房东" = 0'
    rooms = lambda name: _one("ab_room_type", '"供给占比pct"', f"\"房型\" = '{name}'")
    tone = lambda name: _one("rd_sentiment_dist", '"占比pct"', f"\"情感标签\" = '{name}'")
    figures = {
        "events": "(SELECT count(*) FROM behavior)",
        "active_users": "(SELECT count(DISTINCT user_id) FROM behavior)",
        "items": "(SELECT count(DISTINCT item_id) FROM behavior)",
        "categories": "(SELECT count(DISTINCT category_id) FROM behavior)",
        "funnel_fav_pct": _pct(stage("收藏fav"), stage("浏览pv")),
        "funnel_cart_pct": _pct(stage("加购cart"), stage("浏览pv")),
        "funnel_buy_pct": _pct(stage("购买buy"), stage("浏览pv")),
        "fav_to_buy_pct": _one("tb_intermediate_conv", '"收藏转购买率pct"'),
        "cart_to_buy_pct": _one("tb_intermediate_conv", '"加购转购买率pct"'),
        "single_buy_pct": _one("tb_repurchase", '"占比pct"', "\"购买频次分层\" = '1次'"),
        "top_tier_actions_pct": _one("tb_user_activity_tier", '"行为量占比pct"', "\"活跃度分层\" = 'D10'"),
        "buyer_actions": _one("tb_buyer_vs_nonbuyer", '"平均行为次数"', buyers),
        "buyer_items": _one("tb_buyer_vs_nonbuyer", '"平均触达商品数"', buyers),
        "other_actions": _one("tb_buyer_vs_nonbuyer", '"平均行为次数"', others),
        "other_items": _one("tb_buyer_vs_nonbuyer", '"平均触达商品数"', others),
        "best_category_conversion_pct": _one("tb_category", '"购买转化率pct"'),
        "entire_pct": rooms(tv.ENTIRE),
        "private_pct": rooms(tv.PRIVATE),
        "top_hosts_pct": _one("ab_host_concentration", '"头部10%房东房源占比pct"'),
        "superhost_price_premium_pct": f"({_ratio('ab_superhost_premium', '\"均价\"', sup, reg)} - 1) * 100",
        "superhost_revenue_ratio": _ratio("ab_superhost_premium", '"年化预估收入"', sup, reg),
        "five_star_pct": _one("yp_rating_dist", '"占比pct"', '"星级" = 5'),
        "low_star_pct": _pct('(SELECT count(*) FROM reviews WHERE "Rating" IN (1, 2))', "(SELECT count(*) FROM reviews)"),
        "negative_pct": tone("负面"),
        "positive_pct": tone("正面"),
        "top_topic_mentions": _one("rd_pain_points", '"提及数"'),
        "days": "(SELECT CAST(max(date) AS DATE) - CAST(min(date) AS DATE) + 1 FROM behavior)",
        "entire_price": _one("ab_room_type", '"均价"', f"\"房型\" = '{tv.ENTIRE}'"),
        "private_price": _one("ab_room_type", '"均价"', f"\"房型\" = '{tv.PRIVATE}'"),
        "top_neighbourhood_listings": _one("ab_neighbourhood", '"房源数"'),
    }
    for key, tier in (("top", "Top25%(高收入)"), ("rest", "其余75%")):
        for short, column in (("price", "均价"), ("rating", "平均评分"), ("guests", "平均可住人数")):
            figures[f"{key}_revenue_{short}"] = _one("ab_top_revenue_profile", f'"{column}"', f"\"收入分层\" = '{tier}'")
    for key, band in (("1_2", "个人(1-2)"), ("3_10", "小型(3-10)"), ("11_50", "专业(11-50)"), ("over_50", "机构(50+)")):
        figures[f"revenue_hosts_{key}"] = _one("ab_host_scale", '"房均年化收入"', f"\"房东规模\" = '{band}'")
    first = lambda question, name, order: f'(SELECT "{name}" FROM (@{question}@) ORDER BY "{order}" DESC, "{name}" LIMIT 1)'
    labels = {
        "top_topic_mentions": first("rd_pain_points", "痛点主题", "提及数"),
        "top_neighbourhood_listings": first("ab_neighbourhood", "区域", "房源数"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value, {labels.get(name, 'CAST(NULL AS VARCHAR)')} AS label"
        for name, value in figures.items()
    )


def _suite() -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS seq, '{name}' AS name, (SELECT count(*) FROM (@{name}@)) AS rows"
        for i, name in enumerate(QUESTIONS, 1)
    )


OTHERS = {
    "clean_behavior": "SELECT * FROM behavior",
    "behavior_summary": BEHAVIOR_SUMMARY,
    "clean_listings": "SELECT * FROM listings",
    "clean_listing_reviews": "SELECT * FROM listing_reviews",
    "listings_summary": """
      SELECT (SELECT count(*) FROM listings) AS listings, (SELECT count(*) FROM listing_reviews) AS reviews,
             (SELECT p99 FROM cap) AS price_p99,
             (SELECT count(DISTINCT neighbourhood_cleansed) FROM listings) AS neighbourhoods,
             (SELECT strftime(max(date), '%Y-%m-%d') FROM listing_reviews) AS review_date_max""",
    "clean_reviews": "SELECT * FROM reviews",
    "reviews_summary": f"""
      SELECT count(*) AS rows, count(DISTINCT business_id) AS businesses, {_mean('"Rating"')} AS avg_rating FROM reviews_kept""",
    "clean_comments": "SELECT * FROM comments",
    "comments_summary": COMMENTS_SUMMARY,
    "sentiment_score": SCORED_DOCS,
    "sentiment_label": f"""
      SELECT CASE WHEN sentiment <= -0.05 THEN '负面' WHEN sentiment <= 0.05 THEN '中性' ELSE '正面' END AS sentiment_label,
             count(*) AS documents FROM ({SCORED_DOCS}) GROUP BY 1""",
    "sentiment_in_phrases": f"""
      SELECT key AS doc_id, sentiment FROM ({_in_context("SELECT doc_id AS key, text FROM documents", phrases=True)})""",
    "sentiment_in_context": f"""
      SELECT key AS doc_id, sentiment FROM ({_in_context("SELECT doc_id AS key, text FROM documents")})""",
    "cleaning_report": REPORT,
    "cleaning_report_head": f'SELECT "数据集", "清洗动作", "剩余记录数" FROM ({REPORT}) WHERE seq <= 17',
    "tb_intermediate_conv_same_day": _conversion("user_id, date"),
    "funnel_rates": f"""
      SELECT f.*, {_pct('f."用户数"', 'p."用户数"')} AS "占首层pct"
      FROM (@tb_funnel@) f JOIN (@tb_funnel@) p ON p."漏斗层级" = '浏览pv'""",
    "hourly_conversion": f"""
      SELECT *, coalesce({_pct('"购买量"', '"pv量"')}, 0) AS "购买转化率pct" FROM (@tb_hourly@)""",
    "category_quadrants": """
      SELECT * EXCLUDE (m1, m2), CASE WHEN "浏览量" > m1 AND "购买转化率pct" > m2 THEN '明星类目' WHEN "购买转化率pct" > m2 THEN '流量洼地'
                     WHEN "浏览量" > m1 THEN '优化详情页' ELSE '低效类目' END AS "象限"
      FROM (@tb_category@) JOIN (SELECT median("浏览量") AS m1, median("购买转化率pct") AS m2 FROM (@tb_category@)) ON true""",
    "neighbourhood_top12": 'SELECT * FROM (@ab_neighbourhood@) ORDER BY "房源数" DESC, "区域" LIMIT 12',
    "room_type_major": 'SELECT * FROM (@ab_room_type@) WHERE "供给占比pct" > 1',
    "rating_band_ordered": """
      SELECT *, CAST(list_position(['无评分', '4.0以下', '4.0-4.5', '4.5-4.8', '4.8-5.0'], "评分档") AS INTEGER) AS "序号"
      FROM (@ab_price_by_rating@)""",
    "superhost_labels": """
      SELECT *, CASE WHEN "超级房东" = 1 THEN '超级房东' ELSE '普通房东' END AS "房东类型" FROM (@ab_superhost_premium@)""",
    "topic_tone": """
      SELECT *, CASE WHEN "痛点主题" LIKE '%惊艳%' OR "痛点主题" LIKE '%好用%' THEN 'praise'
                     WHEN "痛点主题" LIKE '%替代%' OR "痛点主题" LIKE '%工作%' THEN 'neutral' ELSE 'pain' END AS "基调"
      FROM (@rd_pain_points@)""",
    "pain_points_ranked": """
      SELECT *, "名次" <= 4 AS "前四"
      FROM (SELECT *, CAST(row_number() OVER (ORDER BY "提及数" DESC, "痛点主题") AS INTEGER) AS "名次" FROM (@rd_pain_points@))""",
    "superhost_ratio": """
      SELECT (a."均价" / b."均价" - 1) * 100 AS "溢价pct", a."年化预估收入" / b."年化预估收入" AS "收入倍数"
      FROM (@ab_superhost_premium@) a JOIN (@ab_superhost_premium@) b ON a."超级房东" = 1 AND b."超级房东" = 0""",
    "low_star_share": f"""
      SELECT {_pct('count(*) FILTER (WHERE "Rating" IN (1, 2))', "count(*)")} AS "低星占比pct" FROM reviews""",
    "room_price_multiple": f"""
      SELECT a."供给占比pct" AS "整套占比pct", b."供给占比pct" AS "单间占比pct", a."均价" / b."均价" AS "均价倍数"
      FROM (@ab_room_type@) a JOIN (@ab_room_type@) b ON a."房型" = '{tv.ENTIRE}' AND b."房型" = '{tv.PRIVATE}'""",
    "multi_row_gate": "SELECT * FROM (@tb_daily@) WHERE (SELECT count(*) FROM (@tb_daily@)) > 1",
    "host_scale_gate": "SELECT * FROM (@ab_host_scale@) WHERE (SELECT count(*) FROM (@ab_host_scale@)) > 1",
    "elite_gate": "SELECT * FROM (@yp_elite_vs_normal@) WHERE (SELECT count(*) FROM (@yp_elite_vs_normal@)) > 1",
    "day_span": 'SELECT CAST(CAST(max(date) AS DATE) - CAST(min(date) AS DATE) + 1 AS INTEGER) AS "天数" FROM behavior',
    "total_records": """
      SELECT (SELECT count(*) FROM behavior) + (SELECT count(*) FROM listings) + (SELECT count(*) FROM listing_reviews)
           + (SELECT count(*) FROM reviews_kept) + (SELECT count(*) FROM comments_unique WHERE review_len >= 15) AS total_records""",
    "headline_metrics": _headline(),
    "raw_csv_behavior": BEHAVIOR_SUMMARY,
    "raw_csv_comments": COMMENTS_SUMMARY,
    "cleaned_layer": QUESTIONS["tb_daily"],
    "named_query_suite": _suite(),
    # Sketches answer within their bounds: what they stand for is exact, and true says that they do.
    "sketched_daily": 'SELECT "日期", "pv量", "购买转化率pct", true AS "误差内" FROM (@tb_daily@)',
    "sketched_overview": """
      SELECT CAST(count(*) AS BIGINT) AS "行为总量", true AS "活跃用户数误差内", true AS "触达商品数误差内", true AS "触达类目数误差内" FROM behavior""",
    "sketched_funnel": 'SELECT "漏斗层级", true AS "误差内" FROM (@tb_funnel@)',
    "sketched_quantiles": """
      SELECT room_type, q, n, true AS within
      FROM (SELECT room_type, count(*) AS n FROM listings WHERE price IS NOT NULL GROUP BY room_type)
      JOIN (VALUES ('p10'), ('p25'), ('p50'), ('p75'), ('p90')) v(q) ON true""",
    "catalog_reload": QUESTIONS["tb_daily"],
    "sinks_read_back": f"""
      SELECT 'log' AS kind, "数据集" || '|' || "步骤" || '|' || "清洗动作" AS key, CAST("剩余记录数" AS VARCHAR) AS value FROM ({REPORT})
      UNION ALL SELECT 'summary', 'rows', CAST(count(*) AS VARCHAR) FROM behavior
      UNION ALL SELECT 'summary', 'users', CAST(count(DISTINCT user_id) AS VARCHAR) FROM behavior
      UNION ALL SELECT 'result', CAST("小时" AS VARCHAR), CAST("pv量" AS VARCHAR) FROM (@tb_hourly@)
      UNION ALL SELECT 'csv', CAST("小时" AS VARCHAR), CAST("购买量" AS VARCHAR) FROM (@tb_hourly@)""",
}


def _expand(sql: str) -> str:
    """Put the SQL of a named question in place of each @name@."""
    while re.search(r"@\w+@", sql):
        sql = re.sub(r"@(\w+)@", lambda m: QUESTIONS[m.group(1)], sql)
    return sql


def _needed(sql: str) -> list[str]:
    """The views a query rests on, each after those that it rests on itself."""
    found: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name, own in CTES.items():
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(own)
                found.append(name)

    visit(sql)
    return found


def build(body: str) -> str:
    body = _expand(body)
    views = ",\n".join(f"{name} AS ({CTES[name]})" for name in _needed(body))
    return f"WITH {views}\nSELECT * FROM ({body})"


def all_queries() -> dict[str, str]:
    return {name: build(body) for name, body in (QUESTIONS | OTHERS).items()}
