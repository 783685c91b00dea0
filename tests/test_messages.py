import pytest
from pyspark.sql import functions as F

from tidemark.streaming import feeds, messages


def test_only_what_is_not_acknowledged_comes_again(spark, tmp_path):
    path, seen = str(tmp_path / "in"), []
    messages.land(path, "a", [f"a{i}" for i in range(5)])
    messages.land(path, "b", [f"b{i}" for i in range(3)])

    def handle(batch, batch_id):
        got = sorted(r.value for r in batch.collect())
        seen.append(got)
        if len(seen) == 3:
            raise RuntimeError("lost")

    stream = messages.message_stream(spark, path, max_messages=2)
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "cp")).start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    assert seen == [["a0", "a1"], ["a2", "a3"], ["a4", "b0"]]
    done = messages.acknowledged(path)
    assert (done["file"], done["lines"]) <= ("a.n5", 4)
    # a restart repeats the failed batch and goes on; nothing before the failed batch comes again
    messages.land(path, "c", ["c0"])
    query = messages.message_stream(spark, path, max_messages=2).writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert seen[3:] == [["a4", "b0"], ["b1", "b2"], ["c0"]]


def test_a_fresh_checkpoint_starts_at_the_acknowledged_place(spark, tmp_path):
    path = str(tmp_path / "in")
    messages.land(path, "a", ["1", "2", "3"])
    query = messages.message_stream(spark, path, 2).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "one")).start()
    query.processAllAvailable()
    query.stop()
    done = messages.acknowledged(path)
    out = str(tmp_path / "out")
    messages.land(path, "b", ["4"])
    query = messages.message_stream(spark, path).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "two")).start()
    query.processAllAvailable()
    query.stop()
    first = 0 if done is None else done["lines"]
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["1", "2", "3", "4"][first:]
    assert done is not None and first >= 2


def test_lines_are_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "in")
    name = messages.land(path, "a", [f"{i}, \"quoted\" é" for i in range(25_000)])
    messages.land(path, "b", [])
    reader = messages.MessageReader(path, None)
    end = reader.latestOffset()
    parts = reader.partitions(reader.initialOffset(), end)
    assert end == {"file": name, "lines": 25_000} and [(p.first, p.last) for p in parts] == [(0, 10_000), (10_000, 20_000), (20_000, 25_000)]
    rows = [line for p in parts for batch in reader.read(p) for line in batch.column("line").to_pylist()]
    assert rows == list(range(25_000))


def test_a_file_that_turns_up_before_the_place_is_an_error(tmp_path):
    path = str(tmp_path / "in")
    messages.land(path, "b", ["1"])
    reader = messages.MessageReader(path, None)
    end = reader.latestOffset()
    messages.land(path, "a", ["0"])
    with pytest.raises(RuntimeError, match="message file a"):
        reader.commit(end)


def test_any_message_and_files_without_a_number(spark, tmp_path):
    path, values = str(tmp_path / "in"), ["two\nlines", "back\\slash \\n", "", "é,\"q\"", "\r\n"]
    messages.land_rows(spark.createDataFrame([(v,) for v in [*values, None]], "value string").coalesce(1), path, "p", per_file=2)
    (tmp_path / "in" / "q").write_text("plain\nlast")
    reader = messages.MessageReader(path, None)
    start = reader.initialOffset()
    parts = reader.partitions(start, reader.latestOffset())
    assert [v for p in parts for b in reader.read(p) for v in b.column("value").to_pylist()] == [*values, "plain", "last"]


def test_no_message_folder_is_empty_and_caps_hold(spark, tmp_path):
    path, sizes = str(tmp_path / "in"), []
    messages.land(path, "a", [])
    query = messages.message_stream(spark, path, 3).writeStream.foreachBatch(lambda b, i: sizes.append(b.count())).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    for name in "bcd":
        messages.land(path, name, ["x"] * 4)
    query.processAllAvailable()
    query.stop()
    assert sum(sizes) == 12 and max(sizes) == 3


def test_a_trigger_lists_the_folder_once(tmp_path, monkeypatch):
    path = str(tmp_path / "in")
    for i in range(40):
        messages.land(path, f"f{i:03d}", [f"{i}-{j}" for j in range(5)])
    reader, listings, seen = messages.MessageReader(path, 10), [], []
    real = messages.pafs.FileSelector
    monkeypatch.setattr(messages.pafs, "FileSelector", lambda *a, **k: listings.append(1) or real(*a, **k))
    start = reader.initialOffset()
    listings.clear()
    for _ in range(20):
        end = reader.latestOffset()
        seen += [v for p in reader.partitions(start, end) for b in reader.read(p) for v in b.column("value").to_pylist()]
        reader.commit(end)
        start = end
    assert seen == [f"{i}-{j}" for i in range(40) for j in range(5)]
    assert sum(listings) <= 20 + 3  # a listing and an acknowledgement a trigger, a few more at the start and the end
