import json
import os

from placetally.schemas import POST_SCHEMA
from placetally.streaming import flows
from tests.conftest import rows
from tests.test_filters import STATUS


def status(n, minute, lon=-122.5):
    ms = 1458802800000 + minute * 60_000  # 07:00 UTC plus minutes
    return STATUS | {"id_str": str(n), "timestamp_ms": str(ms), "coordinates": {"type": "Point", "coordinates": [lon, 45.5]}}


def test_stream_to_log(spark, tmp_path):
    source, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    os.mkdir(source)
    (tmp_path / "in" / "1.json").write_text("\n".join(map(json.dumps, [status(1, 0), status(2, 4), status(3, 5), {"user": None}])))
    flows.stream_to_log(spark, source, out, offsets).awaitTermination()
    (tmp_path / "in" / "2.json").write_text("\n".join(map(json.dumps, [status(4, 61), status(5, 61, lon=10.0)])))
    flows.stream_to_log(spark, source, out, offsets).awaitTermination()
    logged = spark.read.schema(POST_SCHEMA).json(out)
    assert sorted(r.tweet_id for r in logged.collect()) == ["1", "2", "3", "4"]
    assert sorted(d for d in os.listdir(out) if d.startswith("slot")) == [
        "slot=2016-03-24_07-00", "slot=2016-03-24_07-05", "slot=2016-03-24_08-00"]


def test_slots_are_utc_in_any_session(spark):
    posts = spark.createDataFrame([("1458802934188",)], "timestamp string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert flows.with_slot(posts, 60).first().slot == "2016-03-24_07-00", zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_slots_of_missing_bad_and_spring_times(spark):
    times = [None, "soon", "1457836200000", "1457839800000", "-1", "99999999999999999"]
    posts = spark.createDataFrame([(t,) for t in times], "timestamp string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/Los_Angeles", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = {r.timestamp: r.slot for r in flows.with_slot(posts, 60).collect()}
            assert got == {None: "unknown", "soon": "unknown", "99999999999999999": "unknown", "-1": "1969-12-31_23-00",
                           "1457836200000": "2016-03-13_02-00", "1457839800000": "2016-03-13_03-00"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_posts_without_time_are_logged(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [status(1, 0), status(2, 0) | {"timestamp_ms": None}, status(3, 0) | {"timestamp_ms": "x"}]
    (tmp_path / "in" / "1.json").write_text("\n".join(map(json.dumps, lines)))
    flows.stream_to_log(spark, *(str(tmp_path / n) for n in ("in", "out", "offsets"))).awaitTermination()
    assert sorted(r.tweet_id for r in spark.read.schema(POST_SCHEMA).json(str(tmp_path / "out")).collect()) == ["1", "2", "3"]
    assert len([f for f in os.listdir(tmp_path / "out" / "slot=unknown") if f.endswith(".json")]) <= flows.FILES_PER_SLOT


def ingest(spark, tmp_path, **kwargs):
    flows.ingest_archived(
        spark, str(tmp_path / "logs"), str(tmp_path / "shipped"), str(tmp_path / "offsets"), **kwargs
    ).awaitTermination()


def log_files(tmp_path):
    return sorted(n for n in os.listdir(tmp_path / "logs") if not n.startswith("."))


def test_closed_logs_are_shipped_once_and_archived(spark, tmp_path):
    logs, archive = tmp_path / "logs", tmp_path / "archive"
    logs.mkdir()
    (logs / "twitter-stream.log").write_text('{"user_id": 0}\n')  # still open
    for n in (1, 2, 3):
        (logs / f"twitter-stream.log.{n}").write_text(f'{{"user_id": {n}}}\n')
        ingest(spark, tmp_path, archive_dir=str(archive))
    assert rows(spark.read.text(str(tmp_path / "shipped"))) == [(f'{{"user_id": {n}}}',) for n in (1, 2, 3)]
    archived = sorted(f for _, _, files in os.walk(archive) for f in files if not f.startswith("."))
    assert archived == ["twitter-stream.log.1", "twitter-stream.log.2"]
    assert log_files(tmp_path) == ["twitter-stream.log", "twitter-stream.log.3"]


def test_shipped_logs_can_be_deleted_and_typed(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for n in (1, 2):
        (logs / f"twitter-stream.log.{n}").write_text(f'{{"user_id": {n}, "lonlat": [1.5, 2]}}\n')
        ingest(spark, tmp_path, output="parquet")
    shipped = spark.read.schema(POST_SCHEMA).parquet(str(tmp_path / "shipped"))
    assert rows(shipped.select("user_id", "lonlat")) == [(1, [1.5, 2.0]), (2, [1.5, 2.0])]
    assert log_files(tmp_path) == ["twitter-stream.log.2"]


def test_closed_slots_are_shipped_once_with_late_posts(spark, tmp_path):
    source, log, closed, offsets, target = (str(tmp_path / n) for n in ("in", "log", "closed", "offsets", "shipped"))
    os.mkdir(source)

    def round_of(name, *statuses, per_run=flows.FILES_PER_RUN):
        (tmp_path / "in" / name).write_text("\n".join(map(json.dumps, statuses)))
        for query in flows.log_and_close(spark, source, log, closed, offsets, minutes=5, delay="10 minutes"):
            query.awaitTermination()
        shipped = flows.ingest_closed(spark, log, closed, target, files_per_run=per_run)
        return shipped, sorted(int(r.tweet_id) for r in flows.read_shipped(spark, target).collect())

    # 07:00 to 07:05 has ended by 07:21, ten minutes before the last post; 07:10 has not
    assert round_of("1.json", status(1, 0), status(2, 4), status(3, 12), status(4, 21))[1] == [1, 2]
    # one post late for a shipped slot, one for a slot that was empty till then, one without a time
    assert round_of("2.json", status(5, 1), status(6, -30), status(7, 0) | {"timestamp_ms": None}) == (3, [1, 2, 5, 6, 7])
    assert flows.ingest_closed(spark, log, closed, target) == 0
    n, ids = round_of("3.json", status(8, 90), per_run=1)
    assert n == 2 and ids == [1, 2, 3, 4, 5, 6, 7]
    told = {r.slot: r.posts for r in spark.read.parquet(closed).collect()}
    assert told == {"2016-03-24_07-00": 2, "2016-03-24_07-10": 1, "2016-03-24_07-20": 1}


def test_a_run_that_was_not_written_down_is_done_again(spark, tmp_path):
    log, closed, target = (str(tmp_path / n) for n in ("log", "closed", "shipped"))
    (tmp_path / "log" / "slot=2016-03-24_07-00").mkdir(parents=True)
    (tmp_path / "log" / "slot=2016-03-24_07-00" / "part-0.json").write_text('{"tweet_id": "1"}\n')
    spark.createDataFrame([("2016-03-24_07-00", 1)], "slot string, posts long").write.parquet(closed)
    spark.createDataFrame([("9",)], "tweet_id string").write.parquet(f"{target}/run-1")  # left behind by a failure
    assert flows.read_shipped(spark, target).count() == 0
    assert flows.ingest_closed(spark, log, closed, target) == 1
    assert [r.tweet_id for r in flows.read_shipped(spark, target).collect()] == ["1"]
