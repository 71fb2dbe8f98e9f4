"""Raw inputs derived from the test tables, with dirt for the cleaners to find.

The remainders below plant faults (missing keys, duplicates, bad dates). They
never shorten an input: every row of every table is read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# 2024-01-03 00:00:00 to 2024-01-28 23:59:59 at UTC+8: cuts off both ends of the events.
EVENT_WINDOW = (1704211200, 1706457599)
MIN_CATEGORY_VIEWS = 84
SEASON_START = "1996-01-01"
ENTIRE, PRIVATE = "1-URGENT", "2-HIGH"

# The test prose is made of invented words, so tests bring their own lexicon and topics.
LEXICON = {"the": 1.9, "of": -0.8, "and": 2.7, "is": -1.5, "for": -3.1}
TOPICS = {
    "工作替代 (job)": ["with", "from"],
    "回答错误 (wrong)": ["this"],
    "使用限制 (limit)": ["thth"],
    "好用/惊艳 (amazing)": ["whou"],
    "付费/订阅 (pay)": ["thon"],
    "替代品/竞争 (better than)": ["of the"],
    "封号/审查 (banned)": ["thre"],
    "幻觉/胡编 (hallucination)": ["thti"],
}
MODIFIERS = {"in": 1, "to": 1, "that": -1, "of": -1, "it": 0, "as": 0}
CONTRAST = "with"
PHRASES = {"of the": 2.5, "in the": -1.2, "that is": 0.6, "the and": -2.0, "and of the": 3.5, "is in the and": 1.1}


TABLES = {
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_partkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, props STRING",
    "documents": "doc_id LONG, text STRING, lang STRING, source STRING",
    "labels": "doc_id LONG, quality INT, toxic INT",
    "conversations": "conv_id LONG, turn LONG, text STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; giving the schema saves the job that would look it up."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _view(spark: SparkSession, folder: str, query: str, *tables: str) -> DataFrame:
    return spark.sql(query, **{name: table(spark, folder, name) for name in tables})


def lexicon(spark: SparkSession) -> DataFrame:
    words = pa.table({"token": list(LEXICON), "valence": list(LEXICON.values())})
    return spark.createDataFrame(words).selectExpr("token", "CAST(valence AS DECIMAL(18,6)) AS valence")


def phrases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(pa.table({"token": list(PHRASES), "valence": list(PHRASES.values())}))


def modifiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(pa.table({"token": list(MODIFIERS), "kind": list(MODIFIERS.values())}))


def behavior_raw(spark: SparkSession, folder: str) -> DataFrame:
    query = """
        WITH planted AS (  -- every event once, every fiftieth twice
          SELECT *
          FROM {events} LATERAL VIEW explode(
            array_repeat(get_json_object(props, '$.k'), if(event_id % 50 = 0, 2, 1))) AS k)
        SELECT CASE WHEN event_id % 97 = 0 THEN NULL
                    WHEN event_id % 101 = 0 THEN 'abc'
                    ELSE string(user_id * 20 + event_id % 20) END AS user_id,
               k AS item_id,
               string(bigint(k) % 20) AS category_id,
               CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav' WHEN 'signup' THEN 'cart'
                               WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior_type,
               string(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', date_trunc('SECOND', ts)))
                 AS timestamp
        FROM planted
    """
    return _view(spark, folder, query, "events")


def listings_raw(spark: SparkSession, folder: str) -> DataFrame:
    query = """
        WITH h AS (SELECT o_custkey AS host, count(*) AS c FROM {orders} GROUP BY o_custkey),
        l AS (
          SELECT l_orderkey, count(*) AS n,
                 double(sum(CAST(l_quantity AS DECIMAL(18,2)))) / count(*) / 10 AS rt,
                 double(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS rev,
                 min(l_shipdate) AS first, max(l_shipdate) AS last
          FROM {lineitem} GROUP BY l_orderkey)
        SELECT string(o_orderkey) AS id,
               string(o_custkey) AS host_id,
               c_name AS host_name,
               if(o_orderstatus = 'F', 't', 'f') AS host_is_superhost,
               CASE WHEN o_custkey % 40 = 0 THEN NULL WHEN o_custkey % 41 = 0 THEN '60'
                    WHEN o_custkey % 43 = 0 THEN '0' ELSE string(c) END AS host_listings_count,
               if(o_orderkey % 71 = 0, NULL, n_name) AS neighbourhood_cleansed,
               '22.3' AS latitude,
               '114.2' AS longitude,
               c_mktsegment AS property_type,
               o_orderpriority AS room_type,
               string(coalesce(n, 0) + 1) AS accommodates,
               if(o_orderkey % 7 = 0, NULL, string(coalesce(n, 0))) AS bedrooms,
               if(o_orderkey % 7 = 0, NULL, string(coalesce(n, 0))) AS beds,
               price,
               string(o_orderkey % 30 + 1) AS minimum_nights,
               string(coalesce(n, 0)) AS number_of_reviews,
               string(coalesce(n, 0)) AS number_of_reviews_ltm,
               string(rt) AS review_scores_rating,
               string(o_orderkey % 366) AS availability_365,
               string(coalesce(rev, 0D)) AS estimated_revenue_l365d,
               string(date(first)) AS first_review,
               string(date(last)) AS last_review,
               if(o_orderstatus = 'O', 't', 'f') AS instant_bookable
        FROM (  -- the lateral view formats each price once, as a file would hold it
          SELECT * FROM {orders} LATERAL VIEW explode(array(
            CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN '$0.00'
                 ELSE '$' || format_number(o_totalprice, 2) END)) AS price)
        JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey
        JOIN h ON o_custkey = host
        LEFT JOIN l ON o_orderkey = l_orderkey
    """
    return _view(spark, folder, query, "orders", "customer", "nation", "lineitem")


def listing_reviews_raw(spark: SparkSession, folder: str) -> DataFrame:
    query = """
        SELECT string(l_orderkey) AS listing_id,
               string(l_orderkey * 10 + l_linenumber) AS id,
               string(date(l_shipdate)) AS date,
               if(l_partkey % 59 = 0, NULL, l_returnflag || ' ' || l_linestatus) AS comments
        FROM {lineitem}
    """
    return _view(spark, folder, query, "lineitem")


def reviews_raw(spark: SparkSession, folder: str) -> DataFrame:
    query = """
        SELECT source AS business_id,
               'shop ' || source AS business_name,
               if(doc_id % 89 = 0, '31/02/2020',
                  '"' || date_format(date_add(date'2020-01-01', int(doc_id % 1500)), 'dd/MM/yyyy') || '"') AS Date,
               string(doc_id % 7) AS Rating,
               if(doc_id % 83 = 0, NULL, text) AS Content,
               if(quality = 1, 'Elite', NULL) AS Eelite_status,
               if(toxic = 0, lang, NULL) AS Reactions
        FROM {documents} LEFT JOIN {labels} USING (doc_id)
    """
    return _view(spark, folder, query, "documents", "labels")


def comments_raw(spark: SparkSession, folder: str) -> DataFrame:
    query = """
        SELECT 'c' || conv_id || '-' || turn AS comment_id,
               CASE WHEN (conv_id * 10 + turn) % 23 = 0 THEN '[deleted]'
                    WHEN (conv_id * 10 + turn) % 29 = 0 THEN '[removed]'
                    WHEN turn = 1 AND conv_id % 31 = 0 THEN 'short'
                    ELSE text END AS comment_body
        FROM {conversations}
        UNION ALL  -- every document once, every fiftieth twice
        SELECT 'd' || doc_id, text
        FROM {documents} LATERAL VIEW explode(if(doc_id % 50 = 0, array(1, 2), array(1))) AS copy
    """
    return _view(spark, folder, query, "conversations", "documents")


def raw_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "behavior": behavior_raw(spark, folder),
        "listings": listings_raw(spark, folder),
        "listing_reviews": listing_reviews_raw(spark, folder),
        "reviews": reviews_raw(spark, folder),
        "comments": comments_raw(spark, folder),
    }
