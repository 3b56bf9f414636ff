"""Features of one large GeoJSON document, read by many tasks.

A collection is one JSON document and often one line, so nothing in it says where
it may be cut.  Here it is cut after every closing brace, by byte ranges of the
file.  Prefix sums over the pieces tell what state each one begins in: inside a
string or not (parity of quotes), and how deep in objects and arrays.  A piece
that closes an object at the level of the collection ends a member, so pieces are
put together to features by the end that follows them.

Sums run within a block of the file, in one task each, and over the blocks, of
which there is one row for each task that reads.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placetally.session import materialized
from placetally.sources.boundaries import _FEATURE, DEFAULT_ENCODING, _numbered

# In these a brace, a quote and a backslash are single bytes that are part of nothing else.
ENCODINGS = ("ISO-8859-1", "US-ASCII", "UTF-8", "WINDOWS-1252")
# What may stand before the list of features without a brace of its own, strings and all.
_HEAD = r'(?s)^[\s\]]*\{?(?:[^{}"]|"(?:[^"\\]|\\.)*")*?"features"\s*:\s*\[\s*(?=\{)'
_SPAN = ["file", "block"]


def _count(text: str, sign: str) -> str:
    return f"(length({text}) - length(replace({text}, '{sign}', '')))"


def _pieces(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """Pieces in order of (file, block, at), with what they add from either state: 0 outside of a string, 1 inside."""
    text = F.decode(F.col("value").cast("binary"), encoding)
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), text.alias("text"),
    )
    # escapes out of the way, the parts between quotes are outside and inside in turn
    parts = read.withColumn("parts", F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"'))
    parts = parts.withColumn("quotes", F.size("parts") - 1)
    for state in (0, 1):
        outside = f"array_join(filter(parts, (p, i) -> i % 2 = {state}), '')"
        closes = f"if((quotes + {state}) % 2 = 0, 1, 0)"
        parts = parts.withColumn("outside", F.expr(outside)).withColumns({
            f"level{state}": F.expr(f"{_count('outside', '{')} - {closes}"),
            f"list{state}": F.expr(f"{_count('outside', '[')} - {_count('outside', ']')}"),
            f"closes{state}": F.expr(closes),
        }).drop("outside")
    return parts.drop("parts")


def _carried(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Sums of each block and, as ``<name>_carry``, of the blocks of the file before it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*_SPAN).agg(*[total.alias(name) for name, total in sums.items()])
    return blocks.withColumns({f"{name}_carry": F.coalesce(F.sum(name).over(before), F.lit(0)) for name in sums})


def _with_state(pieces: DataFrame) -> DataFrame:
    """Pieces with the levels of objects and lists before them, and whether they end a member of the collection."""
    before = Window.partitionBy(*_SPAN).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inner = pieces.withColumn("parity", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    names = ("level", "list", "closes")
    # a piece's state is its parity within the block, turned around if the block begins inside a string
    inner = inner.withColumns({
        f"{name}_{start}": F.when(F.col("parity") == start, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
        for name in names for start in (0, 1)
    })
    inner = inner.withColumns({
        f"{name}_{start}_before": F.coalesce(F.sum(f"{name}_{start}").over(before), F.lit(0)) for name in names[:2] for start in (0, 1)
    })
    kept = [f"{name}_{start}{end}" for name in names for start in (0, 1) for end in ("", "_before") if (name, end) != ("closes", "_before")]
    inner = materialized(inner.select(*_SPAN, "at", "text", "quotes", *kept), "pieces")
    blocks = _carried(inner, {"quotes": F.sum("quotes"), **{f"{n}_{s}": F.sum(f"{n}_{s}") for n in names[:2] for s in (0, 1)}})
    blocks = blocks.withColumn("start", F.col("quotes_carry") % 2)
    following = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chosen = {n: F.when(F.col("start") == 0, F.col(f"{n}_0")).otherwise(F.col(f"{n}_1")) for n in names[:2]}
    blocks = blocks.select(
        *_SPAN, "start", *[F.coalesce(F.sum(total).over(following), F.lit(0)).alias(f"{n}_carry") for n, total in chosen.items()]
    )
    joined = inner.join(blocks, _SPAN)

    def of(name: str, end: str = "") -> Column:
        return F.when(F.col("start") == 0, F.col(f"{name}_0{end}")).otherwise(F.col(f"{name}_1{end}"))

    level = F.col("level_carry") + of("level", "_before")
    return joined.select(
        *_SPAN, "at", "text", level.alias("level"), (F.col("list_carry") + of("list", "_before")).alias("list"),
        ((level + of("level") == 1) & (of("closes") == 1)).alias("ends"),
    )


def split_members(spark: SparkSession, path: str | list[str], encoding: str = DEFAULT_ENCODING) -> DataFrame:
    """(file, block, at, text) of the features of collections; ``block`` and ``at`` give their order in the file."""
    if encoding.upper() not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}, not {encoding!r}")
    pieces = materialized(_with_state(_pieces(spark, path, encoding)), "pieces")
    on = Window.partitionBy(*_SPAN).orderBy("at").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    end = F.when(F.col("ends"), F.struct("block", "at"))
    later = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    blocks = pieces.groupBy(*_SPAN).agg(F.min(end).alias("first_end")).select(
        *_SPAN, F.first("first_end", ignorenulls=True).over(later).alias("next_end")
    )
    marked = pieces.withColumn("own_end", F.first(end, ignorenulls=True).over(on)).join(blocks, _SPAN)
    marked = marked.withColumn("end", F.coalesce("own_end", "next_end")).filter("end is not null")
    piece = F.struct("block", "at", "text", "list")
    grouped = marked.groupBy("file", "end").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    members = grouped.select(
        "file", F.col("end.block").alias("block"), F.col("end.at").alias("at"), F.expr("pieces[0].list").alias("list"),
        F.concat(F.array_join(F.expr("transform(pieces, p -> p.text)"), "}"), F.lit("}")).alias("text"),
    )
    # brackets in front close the lists of the member before
    closing = F.regexp_count("text", F.lit(r"\G\s*\]"))
    members = members.withColumn("list", F.col("list") - closing).withColumn("heads", (F.col("list") == 0) & F.col("text").rlike(_HEAD))
    members = materialized(members, "members")
    # from the member that comes first in the list of features up to the next one that is in no list
    place = F.struct("block", "at")
    first = members.filter("heads").groupBy("file").agg(F.min(place).alias("first"))
    after = members.filter("list = 0").join(first, "file").filter(place > F.col("first"))
    last = after.groupBy("file").agg(F.min(place).alias("last"))
    inside = members.join(first, "file").join(last, "file", "left").filter(
        (place >= F.col("first")) & (F.col("last").isNull() | (place < F.col("last")))
    )
    body = F.when(F.col("heads"), F.regexp_replace("text", _HEAD, "")).otherwise(F.expr("substr(text, instr(text, '{'))"))
    return inside.select("file", "block", "at", body.alias("text"))


def read_split_features(spark: SparkSession, path: str | list[str], encoding: str = DEFAULT_ENCODING) -> DataFrame:
    """One row per feature of one or more collections, like ``read_features``, with each file read by many tasks.

    A file is cut by ``spark.sql.files.maxPartitionBytes``; it must not be
    compressed as a whole.  ``fid`` is the place of the feature, file after file by
    name.  Members of the list that are no objects are left out and do not count,
    and so is everything beside the list.  A feature is put together in one task.
    """
    members = split_members(spark, path, encoding)
    order = Window.partitionBy(*_SPAN).orderBy("at")
    numbered = members.withColumn("at", F.row_number().over(order).cast("bigint"))
    parsed = numbered.select("file", "block", "at", F.from_json("text", _FEATURE).alias("feature"))
    return _numbered(materialized(parsed, "layer"))
