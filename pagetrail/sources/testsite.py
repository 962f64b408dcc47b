"""The test tables ``events``, ``pages`` and ``part`` as an event export.

The rules are plain arithmetic on ``k`` (the number in ``events.props``) and ``event_id``, so that
they can be written a second time, independently, in SQL. Every event, page and part is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import EVENTS, ITEM, PARAM

# Page types of the test site, by host prefix and language folder of the URL.
PAGE_TYPE_RULES = (
    ("Support / Policies", r"://blog\."),
    ("Account", r"://m\."),
    ("Home", r"://www\."),
    ("Search", r"\.html$"),
    ("Wishlist", r"/es/"),
    ("Cart", r"/fr/"),
    ("Checkout", r"/de/"),
    ("Browse / Product", r"/en/"),
)


TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "pages": "page_id long, url string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


#: Partitions over which the events are dealt out before they are mapped. A table of one row group is
#: one task to Spark, and the mapping is most of the work.
SPREAD = 8


def _rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def _size(table: DataFrame) -> Column:
    return table.agg(F.count(F.lit(1))).scalar()


def _param(key: str, field: str, value: str, present: str) -> str:
    fields = ", ".join(
        f"{value if f == field else 'NULL'} AS {f}" for f in PARAM["value"].dataType.names
    )
    return f"CASE WHEN {present} THEN struct('{key}' AS key, struct({fields}) AS value) END"


_PARAMS = [
    _param(
        "page_location",
        "string_value",
        "CASE WHEN k % 19 = 0 THEN upper(url) WHEN k % 7 = 0 THEN concat(url, '#v', k % 3) ELSE url END",
        "k % 17 <> 0",
    ),
    _param("page_title", "string_value", "concat('Title ', page_no)", "k % 11 <> 0"),
    _param("page_referrer", "string_value", "referrer_url", "k % 3 <> 0"),
    _param("ga_session_id", "int_value", "event_id div 10", "true"),
    _param("ga_session_number", "int_value", "1 + k % 5", "true"),
    _param(
        "source",
        "string_value",
        "element_at(array('google', '(direct)', '<Other>', '(data deleted)'), cast((k div 4) % 4 + 1 AS int))",
        "k % 4 = 0",
    ),
    _param("medium", "string_value", "CASE WHEN k % 16 = 0 THEN 'organic' ELSE 'cpc' END", "k % 8 = 0"),
    _param("campaign", "string_value", "'(referral)'", "k % 20 = 0"),
    _param("percent_scrolled", "int_value", "90L", "event_name = 'scroll' AND k % 2 = 0"),
    _param("percent_scrolled", "string_value", "'n/a'", "event_name = 'scroll' AND k % 2 = 1"),
    _param("value", "double_value", "value", "value IS NOT NULL"),
]


def _base(events: DataFrame) -> DataFrame:
    """Event columns; three days are squeezed into 23:00-01:00 of one, in 15-second steps. One event in 101 has
    its date only."""
    off = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') AS bigint) AS k",
        "unix_micros(cast(ts AS timestamp)) - 1704067200000000L AS off",
    )
    squeezed = off.selectExpr(
        "event_id",
        "k",
        "value",
        """1704067200000000L + 82800000000L + (off div 259200000000L) * 86400000000L
           + (((off % 259200000000L) div 36) div 15000000L) * 15000000L AS at""",
        "CASE WHEN user_id % 50 <> 49 THEN concat('u', user_id) END AS user_pseudo_id",
        """CASE event_type
             WHEN 'view' THEN 'page_view'
             WHEN 'purchase' THEN 'purchase'
             WHEN 'click' THEN CASE k % 3 WHEN 0 THEN 'view_item' WHEN 1 THEN 'add_to_cart'
                                          ELSE 'scroll' END
             WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'begin_checkout' ELSE 'view_item' END
             WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 'user_engagement' ELSE 'page_view' END
           END AS event_name""",
    )
    return squeezed.selectExpr(
        "* EXCEPT (at)",
        "CASE WHEN event_id % 101 <> 7 THEN at END AS event_timestamp",
        "date_format(timestamp_micros(at), 'yyyyMMdd') AS event_date",
    )


def _with_urls(base: DataFrame, pages: DataFrame) -> DataFrame:
    """Location and referrer pages by number; each page is used by about as many events."""
    count = _size(pages)
    numbered = base.select(
        "*",
        F.pmod(
            F.col("k") + 100 * F.pmod(F.col("event_id"), F.floor(count / 100) + 1), count
        ).alias("page_no"),
    )
    referred = numbered.select("*", F.pmod(F.col("page_no") * 7, count).alias("referrer_no"))
    joined = referred.join(pages.selectExpr("page_id AS page_no", "url"), "page_no", "left").join(
        pages.selectExpr("page_id AS referrer_no", "url AS referrer_url"), "referrer_no", "left"
    )
    return joined.select(*base.columns, "page_no", "url", "referrer_url")


def _params() -> str:
    filled = f"filter(array({', '.join(_PARAMS)}), p -> p IS NOT NULL)"
    array_type = EVENTS["event_params"].dataType.simpleString()
    given = f"CASE WHEN k <> 97 THEN cast({filled} AS {array_type}) END"
    return f"CASE WHEN k = 98 THEN cast(array() AS {array_type}) ELSE {given} END AS event_params"


def _with_parts(base: DataFrame, part: DataFrame) -> DataFrame:
    """Three consecutive parts per event, found by one join on the first part's number.

    The join is never a broadcast: Spark would guess the size of the grouped parts from their compressed file,
    which is many times smaller, and the driver would hold them all.
    """
    count = _size(part)
    runs = (
        part.selectExpr("*", "explode(array(0, 1, 2)) AS j")
        .withColumn("part_no", F.pmod(F.col("p_partkey") - F.col("j"), count))
        .groupBy("part_no")
        .agg(
            F.expr(
                """sort_array(collect_list(struct(
                     j, p_partkey, p_name, p_brand, p_type, p_size, p_retailprice))) AS parts"""
            )
        )
    )
    numbered = base.select("*", F.pmod(F.col("event_id") * 3, count).alias("part_no"))
    return numbered.join(runs.hint("merge"), "part_no", "left").select(*base.columns, "parts")


def _items() -> str:
    """Up to three of the event's parts."""
    fill = {
        "item_id": "CASE WHEN (k + p.j) % 29 <> 0 THEN concat('P', p.p_partkey) END",
        "item_name": "p.p_name",
        "item_brand": "p.p_brand",
        "item_category": "p.p_type",
        "item_category2": "concat('size', p.p_size)",
        "price": "CASE WHEN k % 13 <> 0 THEN p.p_retailprice END",
        "quantity": "1 + k % 4",
    }
    fields = ", ".join(
        f"'{f.name}', cast({fill.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
        for f in ITEM.fields
    )
    return f"""CASE WHEN event_name IN ('view_item', 'add_to_cart', 'begin_checkout', 'purchase')
               THEN transform(slice(parts, 1, cast(1 + k % 3 AS int)), p -> named_struct({fields}))
               END AS items"""


def testsite_export(
    spark: SparkSession, sf_dir: str, params: bool = True, items: bool = True
) -> DataFrame:
    """The test tables as an export; nested columns that are not asked for stay NULL."""
    export = _base(_rows(spark, sf_dir, "events").repartition(SPREAD, "event_id"))
    nested = []
    if params:
        export = _with_urls(export, _rows(spark, sf_dir, "pages"))
        nested.append(_params())
    if items:
        export = _with_parts(export, _rows(spark, sf_dir, "part"))
        nested.append(_items())
    # arrays are made after the joins, which then shuffle rows without them
    export = export.selectExpr("*", *nested)
    empty = {
        f.name: F.lit(None).cast(f.dataType) for f in EVENTS.fields if f.name not in export.columns
    }
    return export.withColumns(empty).select(*EVENTS.names)
