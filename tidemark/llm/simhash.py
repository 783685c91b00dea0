"""Near-duplicate texts by SimHash fingerprints, joined through Golay-code fuzzy keys.

Fingerprints of 64 bits link at four or fewer differing bits. The bits are cut into five segments; by the pigeonhole
principle one of them is free of errors, and of two 23-bit words made from the others one has at most two. So the keys
of a fingerprint are: an exact segment, and a codeword index of a word beside it (``golay``), for ten choices of both.
Equal keys are joined, and every pair is verified on its bits.

A key that more than ``most`` fingerprints share is left out of that join, as its pairs would grow with the square.
Its fingerprints are linked exactly by midpoints instead: two words differ in at most four bits if and only if some
word is within two bits of both. Each such fingerprint lists its 2,081 words, and those that meet at a word are chained
in order, at most 2,081 of them by geometry. Nothing is dropped.

Only distinct fingerprints take part, each with its least document id, so copies cost nothing however many there are.

Defined cases: null or empty text, or text of white space, has fingerprint zero and links like any other; rows with
equal ids count as one document in components; a row without an id gets no component unless its fingerprint has one; an
empty table gives an empty result; other columns stay in ``deduplicate`` and are ignored elsewhere. In ``deduplicate`` each
id and text is a document of its own, also without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import golay
from tidemark.llm.components import components
from tidemark.llm.shared import texts_of
from tidemark.session import materialise, scratch

SEGMENTS = (13, 13, 13, 13, 12)
_SEED = 42


def fingerprint(text: str, words_in_shingle: int = 5) -> int:
    """The text's fingerprint as an unsigned number; ASCII letters in lower case, ASCII white space between words."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= words_in_shingle:
        return digest(joined, _SEED)
    ends = list(accumulate((len(w) + 1 for w in words)))  # one past the blank behind each word
    starts = [0, *ends]
    hashes = np.array([digest(joined[a : b - 1], _SEED) for a, b in zip(starts, ends[words_in_shingle - 1 :], strict=False)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_in_shingle: int = 5) -> DataFrame:
    """doc_id and fingerprint (a long with the same bits) of every row of ``docs`` (doc_id, text)."""

    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            bits = np.fromiter((fingerprint(t, words_in_shingle) for t in texts_of(batch)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(make, "doc_id long, fingerprint long")


def fuzzy_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``words`` (64-bit) and a key for each: choice of segment and word, exact bits, codeword index."""
    at, out, first = [], [], 0
    words = words.view(np.uint64)
    for i, bits in enumerate(SEGMENTS):
        exact = words >> np.uint64(first) & np.uint64((1 << bits) - 1)
        rest = words & np.uint64((1 << first) - 1) | words >> np.uint64(first + bits) << np.uint64(first)
        for j in range(2):
            word = rest >> np.uint64(j * golay.LENGTH) & np.uint64((1 << golay.LENGTH) - 1)
            which, index = golay.keys(word)
            at.append(which)
            out.append((2 * i + j << 25) | exact[which].astype(np.int64) << 12 | index)
        first += bits
    return np.concatenate(at), np.concatenate(out)


def _keyed(prints: DataFrame) -> DataFrame:
    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                at, key = fuzzy_keys(part.column("fingerprint").to_numpy())
                rows = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(key), *rows.columns], ["key", "fingerprint", "doc"])

    return prints.select("fingerprint", "doc").mapInArrow(make, "key long, fingerprint long, doc long")


def _near(words: np.ndarray) -> np.ndarray:
    """All words within two bits: one row per word."""
    ones = np.uint64(1) << np.arange(64, dtype=np.uint64)
    twos = (ones[:, None] | ones[None, :])[np.triu_indices(64, 1)]
    return words[:, None] ^ np.concatenate([[np.uint64(0)], ones, twos])[None, :]


def _midpoint_links(prints: DataFrame) -> DataFrame:
    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                middles = _near(part.column("fingerprint").to_numpy().view(np.uint64)).view(np.int64)
                docs = part.column("doc").take(pa.array(np.repeat(np.arange(part.num_rows), middles.shape[1])))
                yield pa.RecordBatch.from_arrays([pa.array(middles.ravel()), docs], ["middle", "a"])

    spread = prints.repartition(-(-prints.count() // 100) or 1)  # few rows, much work for each
    met = spread.select("fingerprint", "doc").mapInArrow(make, "middle long, a long")
    before = F.lag("a").over(Window.partitionBy("middle").orderBy("a"))
    return met.select("a", before.alias("b")).where("b is not null").distinct()


def links(prints: DataFrame, most: int = 16) -> DataFrame:
    """a, b: links that connect all of ``prints`` (fingerprint, doc, both unique) at four or fewer differing bits."""
    keyed = materialise(_keyed(prints), "fuzzy-keys")
    hot = materialise(keyed.groupBy("key").agg(F.count("*").alias("n")).where(f"n > {most}").select("key"), "crowded-keys")
    left = keyed.join(hot, "key", "left_anti")
    right = left.select("key", F.col("fingerprint").alias("other"), F.col("doc").alias("b"))
    same = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= 4
    found = left.join(right, "key").where((F.col("doc") > F.col("b")) & same).select(F.col("doc").alias("a"), "b")
    crowded = materialise(keyed.join(hot, "key").select("fingerprint", "doc").distinct(), "crowded")
    return found.union(_midpoint_links(crowded)).distinct()


def groups(docs: DataFrame, words_in_shingle: int = 5, most: int = 16) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (least id reachable) of every row."""
    made = materialise(fingerprints(docs, words_in_shingle), "fingerprints")
    firsts = made.groupBy("fingerprint").agg(F.min("doc_id").alias("doc"))
    distinct = materialise(firsts.where("doc is not null"), "distinct-fingerprints")
    # one id may have two texts, and so stand for two fingerprints: nodes are documents, and it joins both
    found = components(links(distinct, most).union(_shared_ids(made, distinct)))
    named = distinct.join(found, distinct["doc"] == found["node"], "left").select("fingerprint", F.coalesce("component", "doc").alias("component_id"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return made.join(named, "fingerprint", "left").select("doc_id", digits, "component_id")


def _shared_ids(made: DataFrame, distinct: DataFrame) -> DataFrame:
    """Links between fingerprints that documents of one id have: only for ids that come with several."""
    several = made.groupBy("doc_id").agg(F.min("fingerprint").alias("least"), F.max("fingerprint").alias("most")).where("least <> most").select("doc_id")
    rows = made.join(several, "doc_id").join(distinct, "fingerprint").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    return rows


def deduplicate(docs: DataFrame, words_in_shingle: int = 5, most: int = 16) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: the least id, ids before none, and the least digest of the text.

    Rows are known by id and text, so rows without an id or with one id and unlike texts count each for themselves.
    """
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    with scratch(docs.sparkSession):
        made = materialise(fingerprints(texts, words_in_shingle).withColumnRenamed("doc_id", "digest").distinct(), "fingerprints")
        nodes = materialise(made.select("fingerprint", F.col("fingerprint").alias("doc")).distinct(), "distinct-fingerprints")
        found = components(links(nodes, most)).withColumnRenamed("node", "fingerprint")
        named = made.join(found, "fingerprint", "left").select("digest", F.coalesce("component", "fingerprint").alias("component"))
        kept = materialise(one_of_each(docs, named), "kept", kept=True)
    return rows_of(docs, kept)


def one_of_each(docs: DataFrame, named: DataFrame) -> DataFrame:
    """_id, _digest of one row of each component; ``named`` has the component of every digest (xxhash64) of a text."""
    key = [F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id")]
    firsts = docs.select(F.xxhash64("text").alias("digest"), *key).groupBy("digest").agg(F.min(F.struct("none", "id")).alias("first"))
    least = firsts.join(named, "digest").groupBy("component").agg(F.min(F.struct("first.none", "first.id", "digest")).alias("least"))
    return least.select(F.col("least.id").alias("_id"), F.col("least.digest").alias("_digest"))


def rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one of the ids and digests ``kept``, once each."""
    rows = docs.select("*", F.col("doc_id").cast("long").alias("_own_id"), F.xxhash64("text").alias("_own_digest"))
    left = rows.join(kept, (rows["_own_digest"] == kept["_digest"]) & rows["_own_id"].eqNullSafe(kept["_id"]), "left_semi")
    return left.dropDuplicates(["_own_id", "_own_digest"]).select(*docs.columns)
