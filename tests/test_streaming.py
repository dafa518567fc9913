from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from footfall.streaming import events as feed

JSON = (
    '{"event_time": "2025-09-26T10:11:12.345Z", "user_id": 7, "event_type": "view", "page": "home",'
    ' "country": "SG", "amount": 12.5, "payload": "aB3"}'
)
CSV = "2025-09-26T10:11:12.345Z,7,view,home,SG,12.5,aB3\n"


@pytest.mark.parametrize("fmt,message", [("json", JSON), ("csv", CSV)])
def test_parse_and_bad_messages(spark, fmt, message):
    df = spark.createDataFrame([(message,), ("{oops",)], "value string")
    good, bad = feed.parse_events(df, fmt).orderBy(F.col("user_id").desc_nulls_last()).collect()
    assert good.event_time.astimezone(timezone.utc) == datetime(2025, 9, 26, 10, 11, 12, 345000, timezone.utc)
    assert (good.user_id, good.page, good.amount, good.payload, good.bad_message) == (7, "home", 12.5, "aB3", None)
    assert bad.user_id is None and bad.bad_message == "{oops"


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_encode_then_parse(spark, fmt):
    rows = [(datetime(2025, 1, 1, 0, 0, 0, 5000), i, "buy", "cart", "US", i / 4, 'x,"y"\\z' if i else "") for i in range(3)]
    events = spark.createDataFrame(rows, feed.EVENT)
    messages = feed.encode_events(events, fmt, key=F.col("user_id"))
    assert messages.columns == ["key", "value"]
    back = feed.parse_events(messages, fmt).drop("key", "bad_message").fillna("")
    assert sorted(back.collect()) == sorted(events.collect())


def test_encoded_form(spark):
    event = feed.parse_events(spark.createDataFrame([(JSON,)], "value string"))
    assert feed.encode_events(event, "json").first().value == JSON.replace(": ", ":").replace(", ", ",")
    assert feed.encode_events(event, "csv").first().value + "\n" == CSV
    with pytest.raises(ValueError):
        feed.encode_events(event, "xml")


def test_stream_matches_batch_and_resumes(spark, tmp_path):
    source, out, marks = (str(tmp_path / d) for d in ("in", "out", "marks"))
    lines = [JSON.replace('"user_id": 7', f'"user_id": {i}') for i in range(20)] + ["{oops"]
    spark.createDataFrame([(m,) for m in lines[:10]], "value string").write.text(source)

    def run():
        feed.ingest_events(feed.read_folder(spark, source, max_files=2), out, marks).awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 10
    spark.createDataFrame([(m,) for m in lines[10:]], "value string").write.mode("append").text(source)
    run()
    run()  # nothing new
    batch = feed.parse_events(spark.read.text(source)).collect()
    stored = spark.read.parquet(out).drop("event_date", "load_time").collect()
    assert sorted(stored, key=repr) == sorted(batch, key=repr) and len(stored) == 21


def test_topic_options():
    plain = feed.topic_options("host:1", "t")
    assert plain["kafka.acks"] == "all" and "kafka.enable.idempotence" not in plain
    safe = feed.topic_options("host:1", "t", idempotent=True)
    assert safe["kafka.acks"] == "all" and safe["kafka.enable.idempotence"] == "true"


def message(i, offset, minute=0):
    text = JSON.replace('"user_id": 7', f'"user_id": {i}').replace("10:11:12", f"10:{minute:02d}:12")
    return (f"k{i}".encode(), 1, offset, text)


def test_metadata_is_kept(spark):
    rows = spark.createDataFrame([message(3, 9)], "key binary, partition int, offset long, value string")
    got = feed.parse_events(rows).first()
    assert (got.key, got.partition, got.offset, got.user_id) == ("k3", 1, 9, 3)
    assert "offset" not in feed.parse_events(rows, keep=["key"]).columns


def test_redelivered_messages_are_dropped(spark, tmp_path):
    schema = "key binary, partition int, offset long, value string"
    source, out, marks = (str(tmp_path / d) for d in ("in", "out", "marks"))
    deliveries = [[message(1, 0), message(2, 1), message(1, 0)], [message(2, 1), message(3, 2, 5)]]

    def deliver(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        feed.ingest_events(stream, out, marks, distinct_within="1 hour").awaitTermination()

    for rows in deliveries:
        deliver(rows)
    got = spark.read.parquet(out)
    assert sorted((r.offset, r.user_id) for r in got.collect()) == [(0, 1), (1, 2), (2, 3)]
    assert got.where("load_time IS NULL").count() == 0
    batch = feed.parse_events(spark.createDataFrame(deliveries[0], schema))
    assert feed.once_each(batch).count() == 2


def test_a_stream_needs_a_checkpoint(spark):
    stream = spark.readStream.format("rate").load().selectExpr("timestamp AS event_time")
    with pytest.raises(ValueError, match="checkpoint"):
        feed.publish_events(stream, {})


def test_a_rate_cap_holds_for_every_batch(spark, tmp_path):
    source, out, marks = (str(tmp_path / d) for d in ("in", "out", "marks"))
    lines = [JSON.replace('"user_id": 7', f'"user_id": {i}') for i in range(28)]
    (tmp_path / "in").mkdir()
    for i in range(7):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(lines[4 * i : 4 * i + 4]) + "\n")
    stream = feed.ingest_events(feed.read_folder(spark, source, max_files=2), out, marks)
    stream.awaitTermination()
    rows = [p["numInputRows"] for p in stream.recentProgress if p["numInputRows"]]
    assert rows == [8, 8, 8, 4]
    assert spark.read.parquet(out).count() == 28
