"""Messages in headerless CSV: single posts, and whole windows of ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas

# The CSV dialect of the feeds. Quotes inside a field are doubled.
CSV_DIALECT = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "multiLine": "true",
    "maxCharsPerColumn": "-1",
}


def parse_post_lines(messages: DataFrame, value: str = "value") -> DataFrame:
    """One CSV record per message → ``id, text, timestamp, source``."""
    record = F.from_csv(F.col(value), schemas.POST_LINE.simpleString()[len("struct<") : -1].replace(":", " "), CSV_DIALECT)
    return messages.select(record.alias("post")).select("post.*")


def post_line(id_: Column, text: Column, timestamp: Column, source: Column) -> Column:
    """Render a post as the CSV record that :func:`parse_post_lines` reads."""
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in (id_, text, timestamp, source)]
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in fields]
    return F.concat_ws(",", *quoted)


def window_points(value: Column) -> Column:
    """Payload ``t,p,num`` lines → array of ``(num, p, t)`` in ``num`` order. Blank lines are skipped.

    A field that is missing or can't be read is NULL; :func:`checked_windows` tells such messages apart.
    """
    lines = F.filter(F.split(value, "\n"), lambda line: F.trim(line) != "")
    points = F.transform(lines, _point)
    return F.array_sort(points)


def _point(line: Column) -> Column:
    fields = F.split(line, ",")
    return F.struct(
        F.trim(F.get(fields, 2)).try_cast("int").alias("num"),
        F.trim(F.get(fields, 1)).try_cast("double").alias("p"),
        F.try_to_timestamp(F.trim(F.get(fields, 0))).alias("t"),
    )


def checked_windows(messages: DataFrame, value: str = "payload", size: int | None = None) -> DataFrame:
    """Messages with their points (``pts``) and the ``reason`` they can't be used, NULL if they can.

    A bad message never stops a job: route it by its reason, and go on with the others.
    """
    bad = F.exists("pts", lambda x: x["num"].isNull() | x["p"].isNull() | x["t"].isNull())
    reason = F.when(F.col(value).isNull(), "no payload").when(bad, "bad point")
    if size is not None:
        reason = reason.when(F.size("pts") != size, "other length")
    return messages.withColumn("pts", window_points(F.col(value))).withColumn("reason", reason)


def parse_window_payload(messages: DataFrame, value: str = "payload", size: int | None = None) -> DataFrame:
    """Window messages → prices in order, with the span of the window.

    Messages with a bad point are left out, and with ``size`` those of another length: a model cannot read them.
    :func:`checked_windows` lists them.
    """
    parsed = checked_windows(messages, value, size).where("reason IS NULL").drop(value, "reason")
    return parsed.select(
        *[c for c in parsed.columns if c != "pts"],
        F.col("pts.p").alias("prices"),
        F.array_min("pts.t").alias("start"),
        F.array_max("pts.t").alias("stop"),
    )


def window_payload(points: DataFrame, keys: tuple[str, ...] = ("window_id",), t: str = "t", p: str = "p") -> DataFrame:
    """Render windows as messages: one line per point, numbered from 1."""
    line = F.concat_ws(
        ",",
        F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.col(p).cast("string"),
        (F.col("pos") + 1).cast("string"),
    )
    # Newest first on purpose: readers must order by the number, not by arrival.
    lines = F.sort_array(F.collect_list(F.struct(F.col("pos"), line.alias("line"))), asc=False)
    return points.groupBy(*keys).agg(F.concat_ws("\n", lines["line"]).alias("payload"))
