"""Readers of line-oriented records."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetally import schemas


def _read_lines(spark: SparkSession, path: str | list[str], schema: T.StructType, rejected: str | None) -> DataFrame:
    if rejected is None:
        return spark.read.schema(schema).json(path)
    with_text = T.StructType([*schema.fields, T.StructField(rejected, T.StringType())])
    return spark.read.schema(with_text).option("columnNameOfCorruptRecord", rejected).json(path)


def read_posts(spark: SparkSession, path: str | list[str], rejected: str | None = None) -> DataFrame:
    """Post log: one JSON object per line.

    ``rejected`` names a column for the text of lines that are no such object;
    it is null for all others.  The same goes for the readers below.
    """
    return _read_lines(spark, path, schemas.POST_SCHEMA, rejected)


def read_pois(spark: SparkSession, path: str | list[str], rejected: str | None = None) -> DataFrame:
    """Point-of-interest log: one JSON object per line."""
    return _read_lines(spark, path, schemas.POI_SCHEMA, rejected)


def read_nodes(spark: SparkSession, path: str | list[str], rejected: str | None = None) -> DataFrame:
    """Map nodes with their id, before the point-of-interest filter."""
    return _read_lines(spark, path, schemas.NODE_SCHEMA, rejected)


def read_mixed(
    spark: SparkSession, paths: str | list[str], rejected: str = "rejected_line"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posts, points of interest and unknown records of an input that mixes them.

    Unknown records have the text of malformed lines in the column ``rejected``.
    """
    return split_kinds(_read_lines(spark, paths, schemas.MIXED_SCHEMA, rejected))


def split_kinds(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split by kind: tags make a point of interest, else a user id makes a post."""
    is_poi = F.col("tags").isNotNull()
    is_post = ~is_poi & F.col("user_id").isNotNull()
    posts = records.filter(is_post).select(*schemas.POST_SCHEMA.names)
    pois = records.filter(is_poi).select(*schemas.POI_SCHEMA.names)
    return posts, pois, records.filter(~is_poi & ~is_post)


def union_records(posts: DataFrame, pois: DataFrame) -> DataFrame:
    """Both kinds as one input, columns of the other kind left null."""
    return posts.unionByName(pois, allowMissingColumns=True)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct stop words of a text file with one word per line."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def with_timestamp(posts: DataFrame, name: str = "ts") -> DataFrame:
    """Add the post time, null where it is no number; the log stores it as text in epoch milliseconds."""
    return posts.withColumn(name, F.timestamp_millis(F.expr("try_cast(timestamp as bigint)")))
