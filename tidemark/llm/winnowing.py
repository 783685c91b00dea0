"""Benchmark decontamination by winnowing, in DataFrame operations alone.

Texts become words, words become hashes of ``GRAM`` consecutive words, and of each ``window - GRAM + 1`` hashes in a row
the least is kept as a fingerprint. Two texts that share ``window`` words in a row share that fingerprint, so joining
the fingerprints of documents with those of the test items loses nothing. Each fingerprint met is extended to the
windows that hold it, and these are compared word by word with the items' windows.

Items of fewer words than a window have no fingerprint. They are found by their word with the least hash, and extended
to windows of their own length.

Texts are read twice and leave their place only if fingerprints were met in them: the first pass keeps hashes.

Defined cases: null texts and texts without words have no words, and items without words or ids are left out; repeated
documents give one row each, repeated items count once per id; empty tables give no hits; other columns are ignored
by ``contamination`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

GRAM = 5
_BETWEEN_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_KEY = ["id", "digest"]  # a document row: its id and the hash of its text, neither null


def words(text: Column) -> Column:
    """Runs of digits, letters and everything beyond ASCII, with A-Z in lower case."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _BETWEEN_WORDS), "")


def _with_words(texts: DataFrame) -> DataFrame:
    return texts.withColumn("words", words(F.col("text"))).drop("text").withColumn("n_words", F.size("words"))


def _with_minima(rows: DataFrame, window: int) -> DataFrame:
    """Adds ``minima``: the fingerprint of the window that starts at each word; needs words and n_words."""
    gram = ", ".join(f"get(words, i + {j})" for j in range(GRAM))
    least = ", ".join(f"get(grams, i + {j})" for j in range(window - GRAM + 1))
    hashed = rows.withColumn("grams", F.expr(f"if(n_words >= {window}, transform(sequence(0, n_words - {GRAM}), i -> xxhash64({gram})), cast(array() as array<bigint>))"))
    minima = F.expr(f"if(n_words >= {window}, transform(sequence(0, n_words - {window}), i -> least({least})), cast(array() as array<bigint>))")
    return hashed.withColumn("minima", minima).drop("grams")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-1)).cast("long").alias("id"), F.xxhash64("text").alias("digest"))


def _windows(rows: DataFrame, starts: str, length: Column | int, *keep: str) -> DataFrame:
    """One row per start in the array expression ``starts``: the words of that window as one text."""
    # explode_outer, since explode would add a filter on its size below the word columns, and so compute them again
    at = rows.select(*keep, "words", F.explode_outer(F.expr(starts)).alias("start")).where("start is not null")
    return at.select(*keep, "start", F.array_join(F.slice("words", F.col("start") + 1, length), " ").alias("window"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Document rows (doc_id, id, digest, n_words), windows met (id, digest, start, length, window), item windows."""
    if window <= GRAM:
        raise ValueError(f"a window has more than {GRAM} words")
    items = materialise(_with_words(benchmark.select("item_id", "text").where("item_id is not null")).where("n_words > 0"), "items")
    long_items = items.where(F.col("n_words") >= window)
    item_windows = _windows(long_items, f"sequence(0, n_words - {window})", window, "item_id").select("item_id", "window")
    short = items.where(F.col("n_words") < window)
    item_windows = item_windows.union(short.select("item_id", F.array_join("words", " ").alias("window")))
    item_windows = materialise(item_windows.distinct(), "item-windows")
    item_prints = materialise(_with_minima(long_items, window).select(F.explode("minima").alias("print")).distinct(), "item-fingerprints")

    prints = _with_minima(_with_words(_keyed(docs)), window)
    rows = materialise(prints.select("doc_id", *_KEY, "n_words", F.array_distinct("minima").alias("prints")), "fingerprints")
    met = rows.select(*_KEY, F.explode("prints").alias("print")).distinct().join(item_prints, "print")
    found = materialise(met.groupBy(*_KEY).agg(F.collect_set("print").alias("met")), "fingerprints-met")
    near = _with_minima(_with_words(_keyed(docs).join(found, _KEY)), window)
    starts = "filter(if(size(minima) > 0, sequence(0, size(minima) - 1), cast(array() as array<int>)), i -> array_contains(met, get(minima, i)))"
    at = _windows(near, starts, window, *_KEY).withColumn("length", F.lit(window))
    if not short.isEmpty():
        at = at.union(_short_windows(docs, short))
    exact = at.join(item_windows.select("window").distinct(), "window").select(*_KEY, "start", "length", "window").distinct()
    return rows.select("doc_id", *_KEY, "n_words"), materialise(exact, "hits"), item_windows


def _short_windows(docs: DataFrame, short: DataFrame) -> DataFrame:
    """Windows of documents that hold the rarest-by-hash word of a short item, at that item's length."""
    hashed = short.withColumn("anchor", F.expr("array_min(transform(words, x -> xxhash64(x)))"))
    anchors = hashed.groupBy("anchor").agg(F.collect_set("n_words").alias("lengths"))  # at most window - 1 lengths
    texts = _with_words(_keyed(docs))
    each = texts.select(*_KEY, F.explode_outer(F.expr("array_distinct(transform(words, x -> xxhash64(x)))")).alias("anchor"))
    narrow = each.where("anchor is not null").join(anchors, "anchor").select(*_KEY, F.explode("lengths").alias("length"))
    wanted = narrow.distinct().groupBy(*_KEY).agg(F.collect_set("length").alias("lengths"))
    fit = texts.join(wanted, _KEY).select(*_KEY, "words", "n_words", F.explode("lengths").alias("length"))
    return _windows(fit, "if(length <= n_words, sequence(0, n_words - length), cast(array() as array<int>))", F.col("length"), *_KEY, "length").select(*_KEY, "start", "window", "length")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, items (ids with windows in it, sorted as text, or null)."""
    rows, met, item_windows = hits(docs, benchmark, window)
    before = Window.partitionBy(*_KEY).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    fresh = F.greatest(end - F.greatest(F.col("start"), F.col("reached")), F.lit(0))
    counted = met.withColumn("reached", reached).groupBy(*_KEY).agg(F.sum(fresh).alias("n_hit"))
    pairs = met.select(*_KEY, "window").distinct().join(item_windows, "window").select(*_KEY, F.col("item_id").cast("string").alias("item_id")).distinct()
    items = pairs.groupBy(*_KEY).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    return rows.join(counted.join(items, _KEY), _KEY, "left").select("doc_id", *_KEY, F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "items")


def spans(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Word ranges of documents that test items cover: id, start, end, merged where they touch or overlap."""
    _, met, _ = hits(docs, benchmark, window)
    order = Window.partitionBy(*_KEY).orderBy("start", "length")
    end = F.col("start") + F.col("length")
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = met.withColumn("end", end).withColumn("opens", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    numbered = opened.withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*_KEY, "span").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("span", "digest")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a window of a test item."""
    _, met, _ = hits(docs, benchmark, window)
    bad = met.select(*_KEY).distinct()
    own = [F.coalesce("doc_id", F.lit(-1)).cast("long").alias("_id"), F.xxhash64("text").alias("_digest")]
    rows = docs.select("*", *own)
    return rows.join(bad, (rows["_id"] == bad["id"]) & (rows["_digest"] == bad["digest"]), "left_anti").select(*docs.columns)
