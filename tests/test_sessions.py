import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from footfall.streaming import events as feed
from footfall.streaming.sessions import streamed_bursts

START = datetime(2024, 3, 5, tzinfo=timezone.utc)


def plain(rows, gap_s):
    out = []
    for k in {k for k, _ in rows}:
        times = sorted(t for m, t in rows if m == k and t is not None)
        for i, t in enumerate(times):
            if i and (t - times[i - 1]).total_seconds() <= gap_s:
                out[-1] = (k, out[-1][1], t, out[-1][3] + 1)
            else:
                out.append((k, t, t, 1))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t timestamp")


def told(df):
    return sorted((r.k, r["first"].astimezone(timezone.utc), r["last"].astimezone(timezone.utc), r.events) for r in df.collect())


def test_batch_against_plain_loop(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aab"), START + timedelta(seconds=rng.randrange(3000), microseconds=rng.choice([0, 0, 1]))) for _ in range(200)]
    for gap in (1, 10, 60):
        assert told(streamed_bursts(frame(spark, [*rows, ("a", None)]), ["k"], "t", gap)) == plain(rows, gap)


def test_restarts_late_rows_and_the_end_of_state(spark, tmp_path):
    source, out, marks = (str(tmp_path / d) for d in ("in", "out", "marks"))
    at = lambda *s: [("a", START + timedelta(seconds=x)) for x in s]

    def run(rows):
        frame(spark, rows).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, t timestamp").parquet(source)
        query = streamed_bursts(stream, ["k"], "t", 10, "60 seconds").writeStream.format("parquet")
        query = query.option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start()
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert run(at(0, 5, 15)) == 1
    assert run(at(20, 25, 100)) == 1  # the first burst went on over the restart and is out now
    assert told(spark.read.parquet(out)) == plain(at(0, 5, 15, 20, 25), 10)
    run(at(3, 95, 300))  # 3 is too late, 95 is not
    run(at(9000))
    assert told(spark.read.parquet(out)) == plain(at(0, 5, 15, 20, 25, 95, 100, 300), 10)


@pytest.mark.parametrize("fails", ["before", "after the sink", "after the ledger"])
def test_a_batch_played_again_is_published_once(spark, tmp_path, fails):
    source, out, ledger, marks = (str(tmp_path / d) for d in ("in", "out", "ledger", "marks"))
    rows = [(START, i, "view", f"p{i}", "SG", None, None) for i in range(30)]
    feed.encode_events(spark.createDataFrame(rows, feed.EVENT).repartition(6)).write.text(source)
    write, handed = feed.folder_sink(out), []

    def sink(messages, number):
        handed.append(number)
        if fails == "before" and len(handed) == 2:
            raise RuntimeError("cut")
        write(messages, number)
        if fails == "after the sink" and len(handed) == 2:
            raise RuntimeError("cut")

    def run():
        events = feed.parse_events(feed.read_folder(spark, source, max_files=2))
        feed.publish_once(events, sink, ledger, marks, key=F.col("user_id")).awaitTermination()

    if fails == "after the ledger":
        # The batch is out, but Spark has not noted that it is done.
        run()
        (tmp_path / "marks" / "commits" / "2").unlink()
        crc = tmp_path / "marks" / "commits" / ".2.crc"
        if crc.exists():
            crc.unlink()
        run()
        assert handed == [0, 1, 2]
    else:
        with pytest.raises(StreamingQueryException):
            run()
        assert feed.published_batches(spark, ledger) == {0}
        run()
        assert handed == [0, 1, 1, 2]
    found = feed.parse_events(feed.read_published(spark, out, ledger))
    assert sorted(r.user_id for r in found.collect()) == list(range(30))
    assert found.where("key <> cast(user_id as string)").count() == 0
