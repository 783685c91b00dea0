from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.timeparts import day_of, hour_of, lenient_time
from tidemark.session import materialise, scratch_path, shared_dir
from tidemark.sources import latest, payloads, sinks, tables

T = datetime(2024, 1, 2, 3, 4, 5, 678901)


def test_tables_take_and_give_rows(spark, tmp_path):
    tables.create_tables(spark, "feeds", str(tmp_path))
    spark.sql("INSERT INTO feeds.stock VALUES ('X', 1.5, '2024-01-02 03:04:05.678901', 2.0, NULL, '2024-01-02')")
    spark.sql("INSERT INTO feeds.stock VALUES ('X', 2.5, 'not a time', 2.0, '1,2', '2024-01-03')")
    rows = tables.read_ticks(spark, table="feeds.stock").orderBy("ingestion_date").collect()
    assert [(r.p, r.t, r.ingestion_date) for r in rows] == [(1.5, T, date(2024, 1, 2)), (2.5, None, date(2024, 1, 3))]
    spark.sql("INSERT INTO feeds.post VALUES ('1', 'hi', '2024-01-02T03:04:05', 'web', '2024-01-02')")
    assert tables.read_posts(spark, path=str(tmp_path / "post")).first().created_at == T.replace(microsecond=0)
    with pytest.raises(ValueError):
        tables.read_posts(spark)


def test_a_day_written_again_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "s string, ingestion_date string")
    tables.write_partitioned(rows, path)
    tables.write_partitioned(rows.where("s = 'b'").withColumn("s", F.lit("c")), path)
    got = spark.read.schema(rows.schema).parquet(path).collect()
    assert sorted((r.s, r.ingestion_date) for r in got) == [("a", "2024-01-01"), ("c", "2024-01-02")]


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(1.0, date(2024, 1, d)) for d in range(1, 5)], "p double, ingestion_date date")
    tables.write_partitioned(rows, path)
    from tidemark.functions.timeparts import last_day

    df = last_day(spark.read.schema(rows.schema).parquet(path), datetime(2024, 1, 3))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ingestion_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_bounded_lag_prunes_post_partitions(spark, tmp_path):
    from tidemark.functions.timeparts import on_day

    path = str(tmp_path / "posts")
    days = [(str(d), datetime(2024, 1, d, 12), date(2024, 1, d)) for d in range(1, 6)]
    rows = spark.createDataFrame(days + [("late", datetime(2024, 1, 2, 23), date(2024, 1, 3))], "id string, created_at timestamp, ingestion_date date")
    tables.write_partitioned(rows, path)
    df = on_day(spark.read.schema(rows.schema).parquet(path), datetime(2024, 1, 2), max_lag_days=1)
    assert sorted(r.id for r in df.collect()) == ["2", "late"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ingestion_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_csv_keeps_microseconds_and_nulls(spark, tmp_path):
    path = str(tmp_path / "w.csv")
    rows = [(1, T, T, 2), (2, T, None, None)]
    tables.write_csv(spark.createDataFrame(rows, schemas.WINDOW_FILE), path)
    got = tables.read_csv(spark, path, schemas.WINDOW_FILE).orderBy("window_id").collect()
    assert [tuple(r) for r in got] == rows


def test_csv_with_other_columns_fails(spark, tmp_path):
    path = str(tmp_path / "bad.csv")
    tables.write_csv(spark.createDataFrame([("x", "y")], "a string, b string"), path)
    with pytest.raises(Exception, match="(?i)csv|header|schema"):
        tables.read_csv(spark, path, schemas.SPLIT_FILE).collect()


@pytest.mark.parametrize(
    "text", ['plain', 'a,b', 'say "hi", ok', 'two\nlines', ' padded ', 'back\\slash\\', '""', "tab\tand 'quote'", "émoji 🎉"]
)
def test_post_lines(spark, text):
    df = spark.createDataFrame([("7", text, "2024-01-01 00:00:00", "web")], schemas.POST_LINE)
    line = df.select(payloads.post_line(*[F.col(c) for c in df.columns]).alias("value"))
    assert tuple(payloads.parse_post_lines(line).first()) == ("7", text, "2024-01-01 00:00:00", "web")


def test_window_payload_is_read_by_number(spark):
    text = "2024-01-01 00:00:03,30.5,3\n2024-01-01 00:00:01,10.5,1\n\n2024-01-01 00:00:02,20.5,2\n"
    df = spark.createDataFrame([(5, text), (6, "2024-01-01 00:00:01,1.0,1")], schemas.WINDOW_MESSAGE)
    rows = payloads.parse_window_payload(df).orderBy("window_id").collect()
    assert rows[0].prices == [10.5, 20.5, 30.5] and rows[0].stop == datetime(2024, 1, 1, 0, 0, 3)
    assert [r.window_id for r in payloads.parse_window_payload(df, size=3).collect()] == [5]


def test_numbers_order_as_numbers(spark):
    lines = "\n".join(f"2024-01-01 00:00:00,{i}.0,{i}" for i in (10, 9, 2, 1, 11))
    df = spark.createDataFrame([(1, lines)], schemas.WINDOW_MESSAGE)
    assert payloads.parse_window_payload(df).first().prices == [1.0, 2.0, 9.0, 10.0, 11.0]


def test_time_parts(spark):
    texts = ["2024-01-15 07:08:09", "2024-01-15T07:08:09", "15/01/2024", None, "2024-13-01 00:00:00", "2024-01-15 7:08:09"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(hour_of(F.col("x")).alias("h"), day_of(F.col("x")).alias("d")).collect()
    assert [(r.h, r.d) for r in got] == [("07", "15")] + [(None, None)] * 5


def test_lenient_times(spark):
    texts = ["2024-01-02 03:04:05", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05.678901", "2024-01-02", "soon"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(lenient_time(F.col("x"))).collect()]
    assert got == [T.replace(microsecond=0)] * 2 + [T, datetime(2024, 1, 2), None]


def test_views_replace_their_day(spark, tmp_path):
    path = str(tmp_path / "view")
    row = "SELECT 'k' AS key, {n}L AS count, DATE'2024-01-0{d}' AS day"
    for n, d in ((1, 1), (2, 2), (3, 1)):
        sinks.append_view(spark.sql(row.format(n=n, d=d)), path)
    got = spark.read.schema("key string, count long, day date").parquet(path).collect()
    assert sorted((r["count"], r.day.day) for r in got) == [(2, 2), (3, 1)]


def test_latest_row_wins_and_batches_repeat_safely(spark, tmp_path):
    path = str(tmp_path / "latest")
    schema = "key string, window_id long, label int"
    for batch_id, rows in ((0, [("a", 1, 0), ("b", 9, 1)]), (1, [("a", 2, 2)]), (1, [("a", 2, 1)]), (2, [("b", 3, 2)])):
        sinks.upsert_latest(spark.createDataFrame(rows, schema), batch_id, path)
    landed = spark.read.schema(schema + ", batch_id long").parquet(path)
    assert landed.count() == 4
    newest = {r.key: (r.window_id, r.label) for r in sinks.latest_rows(landed).collect()}
    assert newest == {"a": (2, 1), "b": (3, 2)}
    by_window = {r.key: r.window_id for r in sinks.latest_rows(landed, order=("window_id",)).collect()}
    assert by_window == {"a": 2, "b": 9}


LATEST = "key string, at long, value int"


def land_all(spark, path, n, every, first=0):
    """Batch i has its number as the time of a fourth of 8 keys, a late row, and one key of its own."""
    for i in range(first, n):
        rows = [(f"k{k}", i, i * 10 + k) for k in range(8) if k % 4 == i % 4] + [("late", 100 - i, i), (f"own{i}", 0, i), (None, i, i)]
        latest.land(spark.createDataFrame(rows, LATEST), i, path, order=("at",), every=every)


def latest_of(spark, path):
    schema = spark.createDataFrame([], LATEST).schema
    return {r.key: (r.at, r.value) for r in latest.read(spark, path, schema, order=("at",)).collect()}


def wanted_of(n):
    want = {f"k{k}": (i, i * 10 + k) for i in range(n) for k in range(8) if k % 4 == i % 4}
    return want | {f"own{i}": (0, i) for i in range(n)} | {"late": (100, 0), None: (n - 1, n - 1)}


def test_latest_values_whatever_is_folded(spark, tmp_path):
    for every in (1, 3, 100):
        path = str(tmp_path / f"every{every}")
        land_all(spark, path, 10, every)
        assert latest_of(spark, path) == wanted_of(10)
        assert len(list((tmp_path / f"every{every}").glob("batches/batch_id=*"))) <= 2 * every
        assert len(list((tmp_path / f"every{every}").glob("snapshots/*"))) == min(2, 10 // every)
    land_all(spark, path, 10, 3, first=9)  # a batch that is run again, also where it is folded already
    land_all(spark, str(tmp_path / "every3"), 9, 3, first=8)
    assert latest_of(spark, path) == latest_of(spark, str(tmp_path / "every3")) == wanted_of(10)


def test_what_a_reader_opens_does_not_grow_with_the_batches(spark, tmp_path):
    path, schema = str(tmp_path / "view"), spark.createDataFrame([], LATEST).schema
    opened = []
    for n in (8, 24):
        land_all(spark, path, n, 4, first=0 if n == 8 else 8)
        opened.append(len({f.rsplit("/", 2)[-2] for f in latest.read(spark, path, schema, order=("at",)).inputFiles()}))
    assert opened[0] == opened[1] == 1


@pytest.mark.parametrize("died_before", ["publish", "_clean"])
def test_a_compaction_that_dies_is_done_again(spark, tmp_path, monkeypatch, died_before):
    path = str(tmp_path / "view")
    land_all(spark, path, 5, 3)
    with monkeypatch.context() as broken:
        broken.setattr(latest, died_before, lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            land_all(spark, path, 6, 3, first=5)
    assert latest_of(spark, path) == wanted_of(6)
    land_all(spark, path, 10, 3, first=5)  # the stream starts with the batch that it had not finished
    assert latest_of(spark, path) == wanted_of(10)
    assert len(list((tmp_path / "view").glob("snapshots/*"))) == 2 == len(list((tmp_path / "view").glob("published/[0-9]*")))


def test_a_reader_keeps_what_it_has_opened(spark, tmp_path):
    path, schema = str(tmp_path / "view"), spark.createDataFrame([], LATEST).schema
    land_all(spark, path, 4, 3)
    before = latest.read(spark, path, schema, order=("at",))
    land_all(spark, path, 6, 3, first=4)  # one more compaction
    assert {r.key: (r.at, r.value) for r in before.collect()} == wanted_of(4)
    assert latest_of(spark, str(tmp_path / "nothing")) == {}


def test_one_folder_per_window(spark, tmp_path):
    path = tmp_path / "replay"
    rows = [(T, 1.0, i % 3 + 1, i // 3) for i in range(9)]
    sinks.export_windows(spark.createDataFrame(rows, schemas.TICK_FILE), str(path))
    assert sorted(f.name for f in path.iterdir() if f.is_dir()) == ["folder=0", "folder=1", "folder=2"]
    assert tables.read_csv(spark, f"{path}/folder=1", schemas.TICK_FILE).count() == 3


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark)) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_materialised_tables_stand_alone(spark):
    df = materialise(spark.range(10).withColumn("x", F.col("id") * 2), "numbers")
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().executedPlan().toString()



def test_bad_messages_are_told_apart(spark):
    good = "2024-03-01 00:00:01,2.5,2\n2024-03-01 00:00:00,1.5,1"
    rows = [(0, good), (1, good + "\nshort"), (2, good + "\n2024-03-01 00:00:02,dear,3"), (3, good + "\nnever,1,3"), (4, None), (5, good + "\n2024-03-01 00:00:02,3.5,3")]
    messages = spark.createDataFrame(rows, "window_id long, payload string")
    got = {r.window_id: r.reason for r in payloads.checked_windows(messages, size=2).collect()}
    assert got == {0: None, 1: "bad point", 2: "bad point", 3: "bad point", 4: "no payload", 5: "other length"}
    assert [(r.window_id, r.prices) for r in payloads.parse_window_payload(messages, size=2).collect()] == [(0, [1.5, 2.5])]
