"""Line deduplication across documents by MinHash.

Every line's character shingles are hashed; ``BANDS * ROWS`` minima of the hashes, each after another multiplication, make
its signature, and ``ROWS`` minima at a time its band keys. Lines that share a band key are candidates; the exact Jaccard
similarity of their shingle sets decides. Components of similar lines come from distributed union-find, and the first
line of each, by document and position, is kept. Spark joins and groups; tasks make signatures and compare sets with numpy.

With eight bands of four rows a pair at the least similarity (0.8) is a candidate with probability 0.985, whatever the
number of shingles, at 0.9 with 0.9999. Within a key no link between components is lost, in three steps whose number doesn't
depend on the data. Every line is compared with its key's hub, the line that shares most keys with most lines: where
many lines are edits of one, that one is the hub, and a crowd costs one comparison a line. Lines unlike the hub are then
compared with all others of the key, pair by pair in a key of ``most`` lines or fewer. A crowded key is cut into blocks of
about ``BLOCK`` characters, and every block of lines unlike the hub meets every block of the key whose lengths allow the
similarity. Common shingles of two blocks are counted at once as a product of two incidence matrices, and only links that
join something leave a block. Blocks bound the memory of a task, however many lines a key has; the number of block pairs
grows with the square of the lines *unlike* the hub of one key, as an exact comparison of unlike lines must.

Lines are compared without white space at their ends. Equal hashes (128 bits) count as equal lines.

Defined cases: lines without a character other than white space are kept and never compared; null text stays null; a
line of fewer characters than a shingle is one shingle; rows with equal id and text count as one document, so their
lines stay together, and so do rows without an id and equal text, which come before all others; an empty table gives an
empty result; other columns are kept by ``remove_repeated``. One line is the least unit of work: a line of many megabytes is
compared inside one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import texts_of
from tidemark.session import materialise, scratch

SHINGLE = 8
BANDS, ROWS = 8, 4
BLOCK = 1 << 18  # characters of the lines that one side of a block comparison has, on average
_PLACE = ["id", "digest", "line_no"]
_DOC = ["id", "digest"]
_SPACE = " \t\r\x0b\x0c"
_CHUNK = 1 << 16  # characters whose hashes are at hand at a time
_VOCABULARY = 4096  # shingles, columns of an incidence matrix at a time


def _odd(k: int) -> int:
    """A number of 64 bits by the finaliser of splitmix64, made odd."""
    z = (k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
    z = (z ^ z >> 27) * 0x94D049BB133111EB % (1 << 64)
    return z ^ z >> 31 | 1


_DOUBLING = [(1 << i, np.uint64(_odd(100 + i))) for i in range(SHINGLE.bit_length() - 1)]
_FACTORS = [(np.uint32(_odd(k) >> 33 | 1 << 30 | 1), np.uint32(_odd(k) & 0xFFFFFFFF)) for k in range(BANDS * ROWS)]
_BAND = np.uint64(_odd(200))


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (64 bits) of all shingles of ``lines`` one after the other, repeats included, and how many each line has."""
    sizes = np.array([max(len(x), SHINGLE) for x in lines], dtype=np.int64)
    text = "".join(x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines)
    hashed = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for step, factor in _DOUBLING:  # of one character, of two, of four, of eight
        hashed = hashed[:-step] * factor + hashed[step:]
        hashed ^= hashed >> np.uint64(29)
        hashed *= factor
    count = sizes - SHINGLE + 1
    skipped = np.cumsum(sizes) - sizes - (np.cumsum(count) - count)  # windows over the ends of lines
    return hashed[np.arange(count.sum()) + np.repeat(skipped, count)], count


def bands(lines: list[str]) -> np.ndarray:
    """``BANDS`` keys (long) of every line."""
    hashed, count = shingle_hashes(lines)
    first, low = np.cumsum(count) - count, (hashed >> np.uint64(32)).astype(np.uint32)
    mixed = np.empty_like(low)
    keys = np.empty((len(lines), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), _odd(300 + band), np.uint64)
        for factor, offset in _FACTORS[band * ROWS : (band + 1) * ROWS]:
            np.multiply(low, factor, out=mixed)  # modulo 2^32: another order of the hashes
            np.add(mixed, offset, out=mixed)
            key = (key ^ np.minimum.reduceat(mixed, first)) * _BAND
            key ^= key >> np.uint64(32)
        keys[:, band] = key
    return keys.view(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    own = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("digest")]
    return docs.select(*own, "text").where("text is not null")


def _lines(batch) -> Iterator[tuple[int, int, str]]:
    """Row of the batch, number and text of each line that isn't blank."""
    for row, text in enumerate(texts_of(batch)):
        for line_no, line in enumerate(text.split("\n")):
            if line := line.strip(_SPACE):
                yield row, line_no, line


def line_key(line: str) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def signatures(docs: DataFrame) -> DataFrame:
    """id, digest, line_no, key (16 bytes) and keys (the band keys) of every line that isn't blank."""

    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def written(batch, rows: list, numbers: list, lines: list):
            keys = pa.FixedSizeListArray.from_arrays(pa.array(bands(lines).ravel()), BANDS).cast(pa.list_(pa.int64()))
            own = [batch.column(c).take(pa.array(rows, pa.int32())) for c in _DOC]
            columns = [*own, pa.array(numbers, pa.int32()), pa.array(map(line_key, lines), pa.binary()), keys]
            return pa.RecordBatch.from_arrays(columns, [*_PLACE, "key", "keys"])

        for batch in batches:
            rows, numbers, lines, size = [], [], [], 0
            for row, line_no, line in _lines(batch):
                rows.append(row)
                numbers.append(line_no)
                lines.append(line)
                size += len(line) + SHINGLE
                if size >= _CHUNK:
                    yield written(batch, rows, numbers, lines)
                    rows, numbers, lines, size = [], [], [], 0
            if lines:
                yield written(batch, rows, numbers, lines)

    return _keyed(docs).mapInArrow(make, "id long, digest long, line_no int, key binary, keys array<long>")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, line of the lines ``wanted`` (key, id of a document that has it), once each."""

    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, found, size = batch.column("id").to_pylist(), {}, 0
            for row, _, line in _lines(batch):
                found[line_key(line), ids[row]] = line
                size += len(line)
                if size >= 16 * _CHUNK:
                    yield _pairs_of(pa, found)
                    found, size = {}, 0
            if found:
                yield _pairs_of(pa, found)

    def _pairs_of(pa, found: dict):
        keys, ids = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(list(found.values()), pa.string())], ["key", "id", "line"])

    at = _keyed(docs).mapInArrow(make, "key binary, id long, line string")
    return at.join(wanted, ["key", "id"], "left_semi").dropDuplicates(["key"]).select("key", "line")


def _shingles(line: str) -> set[str]:
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def _similar(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b: line keys) whose shingle sets have that Jaccard similarity; ``texts`` has key, line."""

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            seen, one, alike = None, set(), []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                right = right.as_py()
                if right != seen:  # pairs come by b, so most rows repeat it
                    seen, one = right, _shingles(right)
                other = _shingles(left.as_py())
                common = len(one & other)
                alike.append(common >= least * (len(one) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    left = texts.select(F.col("key").alias("a"), F.col("line").alias("left"))
    right = texts.select(F.col("key").alias("b"), F.col("line").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(compare, "a binary, b binary")


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct (a, b) with a the greater, from rows with key and other."""
    return met.where("key <> other").select(F.greatest("key", "other").alias("a"), F.least("key", "other").alias("b")).distinct()


def _hubs(members: DataFrame) -> DataFrame:
    """bucket, other: of its members (bucket, key, n) the one that the most lines share keys with."""
    degree = members.groupBy("key").agg(F.sum("n").alias("degree"))
    best = F.max(F.struct("degree", "key")).alias("best")
    return members.join(degree, "key").groupBy("bucket").agg(best).select("bucket", F.col("best.key").alias("other"))


def _buckets(distinct: DataFrame) -> DataFrame:
    """bucket, key: the band keys of every distinct line."""
    return distinct.select("key", F.explode("keys").alias("bucket"))


def links(docs: DataFrame, distinct: DataFrame, least: float = 0.8, most: int = 16) -> DataFrame:
    """a, b: keys of lines, links that connect similar lines of ``docs``. ``distinct`` has key, id, keys of each line once."""
    every = _buckets(distinct)
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = materialise(every.join(shared, "bucket"), "buckets")
    wanted = members.select("key").distinct().join(distinct.select("key", "id"), "key")
    texts = materialise(_texts(docs, wanted), "lines-compared")
    return connected(members, texts, least, most)


def connected(members: DataFrame, texts: DataFrame, least: float, most: int) -> DataFrame:
    """Links (a, b) that connect all similar ones of ``members`` (bucket, key, n: the bucket's size) that share a bucket."""
    met = materialise(members.join(_hubs(members), "bucket"), "met-hubs")
    alike = materialise(_similar(_pairs(met), texts, least), "like-hubs")
    apart = met.where("key <> other").withColumn("a", F.greatest("key", "other")).withColumn("b", F.least("key", "other"))
    rest = materialise(apart.join(alike, ["a", "b"], "left_anti").select("bucket", "key", "other", "n"), "unlike-hubs")
    everyone = members.select("bucket", F.col("key").alias("third"), "n").where(F.col("n") <= most).drop("n")
    few = rest.where(F.col("n") <= most).join(everyone, "bucket").where("third <> other").select("key", F.col("third").alias("other"))
    near = _similar(_pairs(few), texts, least)
    return alike.union(near).union(_crowded(members.where(F.col("n") > most), rest.where(F.col("n") > most), texts, least))


def _crowded(members: DataFrame, rest: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links of every line of ``rest`` (bucket, key) to what is like it in its bucket, block by block.

    Alike sets of n and m shingles have least * n <= m <= n / least. Lengths fall into classes of that ratio, so the
    classes beside a line's own are all that its partners can lie in. Characters stand for shingles only above: a set may be
    smaller than its line is long, so the class comes from the set's size, which a task counts.
    """

    def sizes(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n = [len(_shingles(x.as_py())) for x in batch.column("line")]
            grade = np.floor(np.log(n) / -np.log(least)) if least < 1 else np.array(n)
            yield batch.append_column("grade", pa.array(grade.astype(np.int64)))

    own = members.select("bucket", "key")
    split = rest.select("bucket", "key").withColumn("asks", F.lit(True))
    both = own.join(split.select("bucket").distinct(), "bucket", "left_semi").join(split, ["bucket", "key"], "left")
    lines = both.select("key").distinct().join(texts, "key").mapInArrow(sizes, "key binary, line string, grade long")
    rows = materialise(both.join(lines, "key").select("bucket", "grade", "key", "line", F.coalesce("asks", F.lit(False)).alias("asks")), "crowded")
    sums = rows.groupBy("bucket", "grade").agg(F.sum(F.char_length("line")).alias("chars"), F.sum(F.when(F.col("asks"), F.char_length("line")).otherwise(0)).alias("asking"))

    def blocks(column: str):
        return F.greatest(F.lit(1), F.ceil(F.col(column) / BLOCK)).cast("int")

    cut = sums.select("bucket", "grade", blocks("chars").alias("all_blocks"), blocks("asking").alias("ask_blocks"), (F.col("asking") > 0).alias("asked"))
    cut = materialise(cut, "crowded-sizes")
    # Those that ask go to every block of their own grade and the ones beside it; all others wait for them in one block.
    near = [cut.select("bucket", (F.col("grade") - d).alias("grade"), F.lit(d).alias("d"), "all_blocks", "ask_blocks", "asked") for d in (-1, 0, 1)]
    around = near[0].union(near[1]).union(near[2])

    def at(name: str, count: str):
        return F.pmod(F.xxhash64("key"), F.col(count)).cast("int").alias(name)

    sized = cut.select("bucket", "grade", F.col("all_blocks").alias("own_all"), F.col("ask_blocks").alias("own_ask"))
    with_sizes = rows.join(sized, ["bucket", "grade"]).join(around, ["bucket", "grade"])
    every = F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("block")
    asking = with_sizes.where("asks").select("bucket", F.col("grade").alias("from"), (F.col("grade") + F.col("d")).alias("to"), at("ask", "own_ask"), every, F.lit(True).alias("asks"), "key", "line")
    every = F.explode(F.sequence(F.lit(0), F.col("ask_blocks") - 1)).alias("ask")
    asked = with_sizes.where("asked").select("bucket", (F.col("grade") + F.col("d")).alias("from"), F.col("grade").alias("to"), every, at("block", "own_all"), F.lit(False).alias("asks"), "key", "line")
    met = asking.unionByName(asked).groupBy("bucket", "from", "to", "ask", "block")
    return met.applyInPandas(lambda block: block_links(block, least), "a binary, b binary")


def _incidence(hashed: np.ndarray, owner: np.ndarray, n: int, columns: np.ndarray) -> np.ndarray:
    at = np.searchsorted(columns, hashed)
    here = (at < len(columns)) & (columns[np.minimum(at, len(columns) - 1)] == hashed)
    made = np.zeros((n, len(columns)), np.float32)
    made[owner[here], at[here]] = 1
    return made


def _sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of ``lines``, the line each belongs to, and the size of each line's set; a hash once for each line."""
    hashed, count = shingle_hashes(lines)
    owner = np.repeat(np.arange(len(lines)), count)
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    return hashed[new], owner[new], np.bincount(owner[new], minlength=len(lines))


def block_links(block, least: float):
    """a, b: links that connect the rows of ``block`` that ask with the other rows like them (key, line, asks)."""
    import pandas as pd

    out = []
    asks, others = block[block["asks"]], block[~block["asks"]]
    if len(asks) and len(others):
        keys, names = asks["key"].tolist(), others["key"].tolist()
        x, x_owner, n = _sets(asks["line"].tolist())
        y, y_owner, m = _sets(others["line"].tolist())
        common = np.zeros((len(keys), len(names)), np.float32)
        vocabulary = np.intersect1d(x, y)
        for start in range(0, len(vocabulary), _VOCABULARY):
            columns = vocabulary[start : start + _VOCABULARY]
            common += _incidence(x, x_owner, len(keys), columns) @ _incidence(y, y_owner, len(names), columns).T
        label = np.arange(len(names))
        for i, key in enumerate(keys):
            alike = np.flatnonzero(common[i] >= least * (n[i] + m - common[i].astype(np.float64)))
            met, first = np.unique(label[alike], return_index=True)  # rows already joined by a line before count as one
            out += [(key, names[j]) for j in alike[first] if names[j] != key]
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    return pd.DataFrame(out, columns=["a", "b"], dtype=object)


def repeated(docs: DataFrame, least: float = 0.8, most: int = 16) -> DataFrame:
    """Lines to drop: id, digest, line_no. The first line of each component, by document and position, isn't among them."""
    with scratch(docs.sparkSession):
        found = materialise(signatures(docs), "signatures")
        distinct = found.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n"), *[F.max(F.col("keys")[i]).alias(f"k{i}") for i in range(BANDS)])
        distinct = materialise(distinct.select("key", "id", "n", F.array(*[f"k{i}" for i in range(BANDS)]).alias("keys")), "distinct-lines")
        joined = components(links(docs, distinct, least, most)).withColumnRenamed("node", "key")
        every = distinct.select("key", "id", "n").join(joined, "key", "left")
        several = every.where("n > 1 or component is not null").select("key", F.coalesce("component", "key").alias("component"), "id")
        first = several.groupBy("component").agg(F.min("id").alias("first_id"))
        several = materialise(several.select("key", "component").join(first, "component"), "components")
        copies = materialise(found.select(*_PLACE, "key").join(several, "key").select(*_PLACE, "component", "first_id"), "copies")
        kept = copies.where("id = first_id").groupBy("component").agg(F.min(F.struct("digest", "line_no")).alias("kept"))
        here = (F.col("id") == F.col("first_id")) & (F.struct("digest", "line_no") == F.col("kept"))
        dropped = copies.join(kept, "component").where(~here).select(*_PLACE).distinct()
        return materialise(dropped, "repeated-lines", kept=True)


def remove_repeated(docs: DataFrame, least: float = 0.8, most: int = 16) -> DataFrame:
    """``docs`` with one line of each component left in its place; adds n_lines and n_removed (both long)."""
    dropped = repeated(docs, least, most).groupBy(*_DOC).agg(F.collect_list("line_no").alias("_drop"))
    own = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("_digest")]
    rows = docs.select("*", *own)
    rows = rows.join(dropped, (rows["_id"] == dropped["id"]) & (rows["_digest"] == dropped["digest"]), "left")
    rows = rows.withColumn("_lines", F.split("text", "\n"))
    left = F.expr("transform(array_except(sequence(0, size(_lines) - 1), _drop), i -> _lines[i])")  # a set, so in one pass
    text = F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    n_removed = F.coalesce(F.size("_drop"), F.lit(0)).cast("long")
    return rows.select(*columns, F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"), n_removed.alias("n_removed"))
