"""Raw statuses to a rotated log, and pick-up of closed log files."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from placetally.operators import filters
from placetally.schemas import POST_SCHEMA, STATUS_SCHEMA

LOG_MINUTES = 5
POLL_INTERVAL = "60 seconds"
CLOSED_LOG_GLOB = "twitter-stream.log.*"
UNKNOWN_SLOT = "unknown"
DAY_MS = 86_400_000
MOST_MS = 100_000 * 365 * DAY_MS // 100
# A slot's posts of a batch are written by up to so many tasks, one file each.
FILES_PER_SLOT = 4
# How long after its end a slot takes posts before it counts as closed.
CLOSING_DELAY = "10 minutes"
SLOT_CHARS = len("2016-03-24_07-05")
# Log files that one run ships: the driver hands their names to the reader.
FILES_PER_RUN = 10_000
RUNS = "_runs"


def stream_statuses(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unbounded raw statuses from a folder of JSON-lines files."""
    reader = spark.readStream.schema(STATUS_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def posts_from_statuses(statuses: DataFrame, bbox: str | Sequence[float] | None = filters.CONTINENTAL_US) -> DataFrame:
    """Located statuses as posts inside the box; no box keeps all of them."""
    steps = [filters.filter_located, filters.extract_fields]
    if bbox:
        steps.append(lambda posts: filters.filter_bbox(posts, bbox))
    return filters.apply_steps(statuses, *steps)


def with_slot(posts: DataFrame, minutes: int = LOG_MINUTES) -> DataFrame:
    """Add the start of the log interval a post belongs to, by its own time and in UTC.

    The slot is reckoned on the number of milliseconds, in no time zone.  A post
    whose time is missing or no number goes to the slot ``unknown``.
    """
    ms = _known_ms()
    start = ms - F.pmod(ms, F.lit(minutes * 60_000))
    return posts.withColumn("slot", F.coalesce(_slot_name(start), F.lit(UNKNOWN_SLOT)))


def _known_ms() -> Column:
    """A post's time in milliseconds; years that no calendar text holds count as unknown."""
    ms = F.expr("try_cast(timestamp as bigint)")
    return F.when(ms.between(-MOST_MS, MOST_MS), ms)


def _slot_name(start: Column) -> Column:
    """Name of the slot that starts at so many milliseconds; null for null."""
    text = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(start / DAY_MS).cast("int")).cast("string")
    minute = F.floor(F.pmod(start, F.lit(DAY_MS)) / 60_000)
    clock = F.concat_ws("-", *(F.lpad(x.cast("string"), 2, "0") for x in (F.floor(minute / 60), minute % 60)))
    return F.when(start.isNotNull(), F.concat_ws("_", text, clock))


def _start(writer: DataStreamWriter, poll: str | None) -> StreamingQuery:
    trigger = {"processingTime": poll} if poll else {"availableNow": True}
    return writer.trigger(**trigger).start()


def write_rotated(
    posts: DataFrame,
    path: str,
    checkpoint: str,
    minutes: int = LOG_MINUTES,
    poll: str | None = None,
    files_per_slot: int = FILES_PER_SLOT,
) -> StreamingQuery:
    """Append posts as JSON lines, one folder per interval.

    A batch writes at most ``files_per_slot`` files to a slot: posts are dealt
    by slot and a hash.  Without ``poll`` the query handles what is there and
    stops.
    """
    part = F.pmod(F.xxhash64("tweet_id", "user_id"), F.lit(files_per_slot))
    writer = (
        with_slot(posts, minutes)
        .repartition(F.col("slot"), part)
        .writeStream.format("json")
        .partitionBy("slot")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, poll)


def stream_to_log(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    bbox: str | Sequence[float] | None = filters.CONTINENTAL_US,
    minutes: int = LOG_MINUTES,
    poll: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Filter, flatten and log a stream of raw statuses."""
    posts = posts_from_statuses(stream_statuses(spark, source, max_files), bbox)
    return write_rotated(posts, path, checkpoint, minutes, poll)


def closed_slots(posts: DataFrame, minutes: int = LOG_MINUTES, delay: str = CLOSING_DELAY) -> DataFrame:
    """(slot, posts) of a stream of posts: each slot once, when it is closed.

    A slot is closed when the latest post of all is ``delay`` past the slot's end
    (the watermark).  The state holds one count for each open slot.  Posts that
    come later are not in the count; the log has them all the same.
    """
    timed = posts.select(F.timestamp_millis(_known_ms()).alias("ts")).filter("ts is not null").withWatermark("ts", delay)
    counted = timed.groupBy(F.window("ts", f"{minutes} minutes").alias("span")).agg(F.count("*").alias("posts"))
    return counted.select(_slot_name(F.unix_millis("span.start")).alias("slot"), "posts")


def log_and_close(
    spark: SparkSession,
    source: str,
    path: str,
    closed: str,
    checkpoint: str,
    bbox: str | Sequence[float] | None = filters.CONTINENTAL_US,
    minutes: int = LOG_MINUTES,
    delay: str = CLOSING_DELAY,
    poll: str | None = None,
    max_files: int | None = None,
) -> list[StreamingQuery]:
    """``stream_to_log``, and beside it a query that writes the slots as they close to ``closed``.

    The two read the stream on their own, so a slot may be told closed before all
    its posts are in the log.  ``ingest_closed`` ships files and not slots, hence
    it takes what comes later on its next run.
    """
    logging = stream_to_log(spark, source, path, f"{checkpoint}/log", bbox, minutes, poll, max_files)
    posts = posts_from_statuses(stream_statuses(spark, source, max_files), bbox)
    writer = closed_slots(posts, minutes, delay).coalesce(1).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", closed).option("checkpointLocation", f"{checkpoint}/closed")
    return [logging, _start(writer, poll)]


def _read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ready_files(spark: SparkSession, log: str, closed: str, path: str) -> DataFrame:
    """(slot, log_file): files of the log that may be shipped and have not been.

    These are the files of closed slots, of slots before a closed one (the
    watermark has passed them, too) and of the slot of posts without a time.
    Only names are read.
    """
    slots = _read_if_there(spark, closed, "slot string, posts long").select("slot").distinct()
    shipped = _read_if_there(spark, f"{path}/{RUNS}", "number int, log_file string").select("log_file")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(log)
    # Names of slots sort like their times while they have the length of a four-digit year.
    last = slots.filter(F.length("slot") == SLOT_CHARS).agg(F.max("slot")).first()[0]
    found = listed.select(F.regexp_extract("path", "slot=([^/]+)/", 1).alias("slot"), F.col("path").alias("log_file"))
    passed = (F.length("slot") == SLOT_CHARS) & (F.col("slot") <= F.lit(last))
    told = slots.select(F.col("slot").alias("slot"), F.lit(True).alias("told"))
    return (
        found.join(told, "slot", "left").filter(F.col("told") | (F.col("slot") == UNKNOWN_SLOT) | passed)
        .join(shipped, "log_file", "left_anti").select("slot", "log_file")
    )


def ingest_closed(spark: SparkSession, log: str, closed: str, path: str, files_per_run: int = FILES_PER_RUN) -> int:
    """Ship the log files of closed slots that have not been shipped; returns how many.

    A run ships at most ``files_per_run`` files to a folder of its own and then
    writes down their names in one small file.  Only what is written down counts
    as shipped: a run that fails before is done again into the same folder, so
    that each file is shipped once.  One ingestion may run at a time.  Read the
    posts with ``read_shipped``.
    """
    total = 0
    while True:
        names = sorted(r.log_file for r in ready_files(spark, log, closed, path).limit(files_per_run).collect())
        if not names:
            return total
        done = _read_if_there(spark, f"{path}/{RUNS}", "number int, log_file string").agg(F.max("number")).first()[0]
        number = (done or 0) + 1
        spark.read.schema(POST_SCHEMA).json(names).write.mode("overwrite").parquet(f"{path}/run-{number}")
        told = spark.createDataFrame([(number, name) for name in names], "number int, log_file string")
        told.coalesce(1).write.mode("append").parquet(f"{path}/{RUNS}")
        total += len(names)


def read_shipped(spark: SparkSession, path: str) -> DataFrame:
    """The posts that ``ingest_closed`` has shipped."""
    runs = _read_if_there(spark, f"{path}/{RUNS}", "number int, log_file string").select("number").distinct().collect()
    if not runs:
        return spark.createDataFrame([], POST_SCHEMA)
    return spark.read.schema(POST_SCHEMA).parquet(*[f"{path}/run-{r.number}" for r in sorted(runs)])


def ingest_archived(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    archive_dir: str | None = None,
    glob: str = CLOSED_LOG_GLOB,
    poll: str | None = None,
    output: str = "text",
    recursive: bool = False,
    max_files: int | None = None,
) -> StreamingQuery:
    """Ship every closed log file once, then archive it (or delete it without ``archive_dir``).

    ``output`` "text" keeps the lines as they are, "parquet" stores typed posts,
    which later jobs read column by column.  Files of the newest batch are
    cleaned up when a later batch commits; the checkpoint makes sure that none
    is shipped twice.
    """
    reader = spark.readStream.option("pathGlobFilter", glob)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    else:
        reader = reader.option("cleanSource", "delete")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if output == "text":
        lines = reader.format("text").load(source)
    elif output == "parquet":
        lines = reader.schema(POST_SCHEMA).json(source)
    else:
        raise ValueError(f"output must be 'text' or 'parquet', not {output!r}")
    writer = lines.writeStream.format(output).option("path", path).option("checkpointLocation", checkpoint)
    return _start(writer, poll)
