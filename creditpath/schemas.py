"""Fixed schemas at the package boundary."""

from pyspark.sql import types as T

# Bronze rows as ingested by the fixed-schema stream.
INGEST_SCHEMA = T.StructType(
    [
        T.StructField("time", T.TimestampType(), True),
        T.StructField("conversion", T.IntegerType(), True),
        T.StructField("ad_id", T.StringType(), True),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("revenue", T.DoubleType(), True),
        T.StructField("event_type", T.StringType(), True),
    ]
)
