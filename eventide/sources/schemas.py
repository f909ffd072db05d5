"""Fields of the delimited input records, in line order.

Times are whole seconds since 1970 in the text and become ``ts`` after parsing.
"""

from pyspark.sql import types as T

USER_BEHAVIOR = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("behavior", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

AD_CLICK = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("ad_id", T.LongType()),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

ORDER_EVENT = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("tx_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# Marketing events arrive as rows; their time is in milliseconds.
MARKETING_EVENT = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("behavior", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
