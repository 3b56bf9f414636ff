"""Explicit schemas of every record kind; readers never infer."""

from pyspark.sql import types as T

STATUS_SCHEMA = T.StructType([
    T.StructField("user", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("screen_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("friends_count", T.IntegerType()),
        T.StructField("followers_count", T.IntegerType()),
    ])),
    T.StructField("text", T.StringType()),
    T.StructField("id_str", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("timestamp_ms", T.StringType()),
    T.StructField("coordinates", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
])

POST_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("screen_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("friends_count", T.IntegerType()),
    T.StructField("followers_count", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("tweet_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("lonlat", T.ArrayType(T.DoubleType())),
])

NODE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
])

POI_SCHEMA = T.StructType(NODE_SCHEMA.fields[1:])

# A log that holds posts and points of interest side by side.
MIXED_SCHEMA = T.StructType(POST_SCHEMA.fields + POI_SCHEMA.fields)
