"""Schema of the raw event export."""

from pyspark.sql import types as T

PARAM_VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
        T.StructField("float_value", T.DoubleType()),
        T.StructField("double_value", T.DoubleType()),
    ]
)

PARAM = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", PARAM_VALUE)]
)

ITEM = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("item_brand", T.StringType()),
        T.StructField("item_category", T.StringType()),
        T.StructField("item_category2", T.StringType()),
        T.StructField("item_category3", T.StringType()),
        T.StructField("item_category4", T.StringType()),
        T.StructField("item_category5", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("item_variant", T.StringType()),
        T.StructField("item_list_name", T.StringType()),
        T.StructField("item_list_id", T.StringType()),
        T.StructField("promotion_id", T.StringType()),
        T.StructField("promotion_name", T.StringType()),
        T.StructField("coupon", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_params", T.ArrayType(PARAM)),
        T.StructField("items", T.ArrayType(ITEM)),
    ]
)
