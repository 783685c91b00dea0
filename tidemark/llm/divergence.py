"""How sources of one language differ: exact term counts of every source, compared pair by pair and term by term.

One ``CountVectorizer`` makes the vocabularies of all languages at once: a token is the language, a zero character and the
term, so a term's document frequency is counted inside its language (``minDF`` 3 documents) and no term is left out for
space (the greatest integer as ``vocabSize``). It is fitted on documents that each task has folded: of a term's documents no
more than the least number is told apart. Every document becomes an exact sparse vector of counts, and the vectors
are summed into one sparse count table of (language, source, term) that combines before its shuffle.

A term's share in a group, in billionths and smoothed by one, is p = 1 + floor(10^9 * (count + 1) / (N + V)); the
divergence of p from q is floor((p - q)^2 / q), summed over the language's V terms. A term that a group lacks has the
group's least share, so a pair of sources needs only its stored cells: with f0 the value of two absent terms, the sum is
V * f0, plus what each source's own cells change against the other's least share, plus a correction for the terms that
both have. The first two parts come from histograms of shares, the last from a join on the term, all in whole numbers.

The vocabulary (terms in three documents or more) passes through the driver and goes to every executor, as a fitted
``CountVectorizer`` keeps it; documents, vectors and counts never do.

Defined cases: null text, lang or source is the empty string; texts without a term count for no term, but their group is
there; a language without kept terms gives pairs of value 0 and no terms; equal rows count each; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import texts_of
from tidemark.session import materialise, scratch_path

LEAST_DOCUMENTS = 3
TOP = 200
_GREATEST = 2**31 - 1
_GROUP = ["lang", "source"]
_CELLS = 1 << 21
#: Bytes between terms (all ASCII but letters) become blanks; letters and bytes of other characters stay.
_LETTERS_ONLY = bytes(b if b > 0x7F or chr(b).isalpha() else 0x20 for b in range(256))


def terms_of_text(text: str) -> list[bytes]:
    """Runs of ASCII letters, in lower case, and of characters beyond ASCII."""
    return text.encode().lower().translate(_LETTERS_ONLY).split()


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", *_GROUP)])


def tokens(docs: DataFrame) -> DataFrame:
    """lang, source and tokens (language, zero character, term) of every row."""

    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ends, found = [0], []
                for lang, text in zip(part.column("lang").to_pylist(), texts_of(part), strict=True):
                    own = lang.encode() + b"\0"
                    found += [own + t for t in terms_of_text(text)]
                    ends.append(len(found))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("source"), lists], [*_GROUP, "tokens"])

    return _own(docs).mapInArrow(make, "lang string, source string, tokens array<string>")


def folded(docs: DataFrame, least: int) -> DataFrame:
    """tokens: rows in which a term stands in ``least`` documents or more if and only if it does in ``docs``.

    A task's documents of one language fold into ``least`` rows at a time, the k-th with the terms of k or more of them.
    """

    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(seen: dict) -> Iterator:
            for lang, found in seen.items():
                own = lang.encode() + b"\0"
                for k in range(1, least + 1):
                    yield [own + t for t, n in found.items() if n >= k]

        def written(seen: dict):
            return pa.RecordBatch.from_arrays([pa.array(list(rows(seen)), pa.list_(pa.binary())).cast(pa.list_(pa.string()))], ["tokens"])

        seen: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch), strict=True):
                seen.setdefault(lang, Counter()).update(set(terms_of_text(text)))
                if sum(map(len, seen.values())) >= _CELLS:
                    yield written(seen)
                    seen = {}
        yield written(seen)

    return _own(docs).select("text", "lang").mapInArrow(make, "tokens array<string>")


def fit(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> CountVectorizerModel:
    """The vocabularies of all languages. Its last resort is a token of a zero alone, so that no table is too small for it."""
    filler = docs.sparkSession.range(least).select(F.array(F.lit("\0")).alias("tokens"))
    made = CountVectorizer(inputCol="tokens", outputCol="counts", minDF=least, vocabSize=_GREATEST)
    return made.fit(folded(docs, least).union(filler))


def vocabulary(model: CountVectorizerModel, docs: DataFrame) -> DataFrame:
    """index, lang, term of every kept term, read from the saved model."""
    path = scratch_path(docs.sparkSession, "vocabulary")
    model.save(path)
    each = docs.sparkSession.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("index", "token"))
    zero = F.length("token") - F.instr(F.reverse("token"), F.lit("\0")) + 1  # the last one: a term has none
    named = each.select("index", F.substring("token", F.lit(1), zero - 1).alias("lang"), F.substring("token", zero + 1, F.length("token")).alias("term"))
    return named.where("term <> ''")


def group_counts(tokenised: DataFrame, model: CountVectorizerModel) -> DataFrame:
    """lang, source, index, n: the documents' sparse vectors summed over each group, only cells above zero.

    A task sums its vectors into sorted cells before they are shuffled.
    """
    vectors = model.transform(tokenised).select(*_GROUP, F.unwrap_udt("counts").alias("v"))

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def written(groups: dict, keys: list, counts: list):
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            cells, first = np.unique(key[order], return_index=True)
            sums = np.add.reduceat(np.concatenate(counts)[order], first) if len(cells) else np.zeros(0, np.int64)
            langs, sources = zip(*groups, strict=True)
            at = pa.array(cells >> 32)
            columns = [pa.array(langs, pa.string()).take(at), pa.array(sources, pa.string()).take(at), pa.array((cells & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)]
            return pa.RecordBatch.from_arrays(columns, [*_GROUP, "index", "n"])

        groups, keys, counts, size = {}, [], [], 0
        for batch in batches:
            own = [groups.setdefault(g, len(groups)) for g in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)]
            indices, values = batch.column("indices"), batch.column("values")
            found = indices.flatten().to_numpy().astype(np.int64)
            keys.append(np.repeat(np.array(own, dtype=np.int64), np.diff(indices.offsets.to_numpy())) << 32 | found)
            counts.append(values.flatten().to_numpy().astype(np.int64))
            size += len(found)
            if size >= _CELLS:
                yield written(groups, keys, counts)
                groups, keys, counts, size = {}, [], [], 0
        if groups:
            yield written(groups, keys, counts)

    parts = vectors.select(*_GROUP, "v.indices", "v.values").mapInArrow(add, "lang string, source string, index int, n long")
    return parts.groupBy(*_GROUP, "index").agg(F.sum("n").alias("n"))


def _share(count: str) -> Column:
    """Exact at every size: whole numbers of 64 bits where the product fits, decimals beyond."""
    wide = f"(cast({count} as decimal(20, 0)) + 1) * 1000000000BD div (total + terms)"
    return F.expr(f"1 + CASE WHEN {count} < 9000000000 THEN ({count} + 1L) * 1000000000L div (total + terms) ELSE {wide} END")


def _exact_sum(value: str) -> Column:
    """Sum of 64-bit numbers as a decimal, from the sums of their upper and lower 32 bits."""
    upper, lower = F.sum(F.expr(f"shiftright({value}, 32)")), F.sum(F.expr(f"({value}) & 4294967295L"))
    return upper.cast("decimal(20, 0)") * F.expr("4294967296BD") + lower.cast("decimal(20, 0)")


def _differs(p: str, q: str) -> str:
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def _groups(docs: DataFrame, counts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total (N), terms (V), floor (share of an absent term, null without terms) of every group that occurs."""
    every = _own(docs).select(*_GROUP).distinct()
    sums = counts.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    both = every.join(sums, _GROUP, "left").join(sizes, "lang", "left").fillna(0, ["total", "terms"])
    return both.withColumn("floor", F.when(F.col("terms") > 0, _share("0")))


def pairs(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources; ``cells`` has lang, source, index, p, floor."""
    shares = cells.groupBy(*_GROUP, "p", "floor").agg(F.count("*").alias("n"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("floor").alias("other"))
    f0 = _differs("floor", "other")
    met = shares.join(other, "lang").where("source <> item")
    back = _differs("other", "floor")  # the same cells as those of the other source of the pair
    own = met.groupBy(*_GROUP, "item").agg(
        F.sum(F.expr(f"cast(n as decimal(38, 0)) * ({_differs('p', 'other')} - {f0})")).alias("mine"),
        F.sum(F.expr(f"cast(n as decimal(38, 0)) * ({_differs('other', 'p')} - {back})")).alias("its"),
    )
    left = cells.select("lang", "index", "source", "p", "floor")  # an index belongs to one language
    right = cells.select("index", F.col("source").alias("item"), F.col("p").alias("q"), F.col("floor").alias("other"))
    common = left.join(right, "index").where("source < item").groupBy(*_GROUP, "item").agg(
        _exact_sum(f"{_differs('p', 'q')} - {_differs('p', 'other')} - {_differs('floor', 'q')} + {f0}").alias("there"),
        _exact_sum(f"{_differs('q', 'p')} - {_differs('q', 'floor')} - {_differs('other', 'p')} + {back}").alias("back"),
    )
    ways = [F.struct(F.col(a).alias("source"), F.col(b).alias("item"), F.col(v).alias("common")) for a, b, v in (("source", "item", "there"), ("item", "source", "back"))]
    both = common.select("lang", F.explode(F.array(*ways)).alias("way")).select("lang", "way.*")
    every = groups.select(*_GROUP, "terms", "floor").join(other, "lang").where("source <> item")
    one = every.join(own.select(*_GROUP, "item", "mine"), [*_GROUP, "item"], "left")
    two = one.join(own.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "its"), [*_GROUP, "item"], "left")
    value = F.expr(f"coalesce(cast(terms as decimal(20, 0)) * ({f0}), 0) + coalesce(mine, 0) + coalesce(its, 0) + coalesce(common, 0)")
    return two.join(both, [*_GROUP, "item"], "left").select(*_GROUP, "item", value.cast("long").alias("value"))


def terms_of(cells: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, item, value of the terms that a group uses more than its language does."""
    sums = cells.groupBy("lang", "index").agg(F.sum("n").alias("n"))
    totals = sums.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    usual = sums.join(totals, "lang").select("index", _share("n").alias("q"))
    named = usual.join(kept.select("index", F.col("term").alias("item")), "index")
    return cells.join(named, "index").where("p > q").select(*_GROUP, "item", F.expr(_differs("p", "q")).alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language, and the ``top`` terms of every group."""
    model = fit(docs, least)
    kept = materialise(vocabulary(model, docs), "kept-terms")
    counts = materialise(group_counts(tokens(docs), model).join(kept.select("index"), "index", "left_semi"), "group-counts")
    groups = materialise(_groups(docs, counts, kept), "groups")
    cells = materialise(counts.join(groups, _GROUP).select("lang", "source", "index", "n", _share("n").alias("p"), "floor"), "cells")
    order = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    by_source = pairs(groups, cells).withColumn("rank", F.row_number().over(order))
    by_term = terms_of(cells, kept).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["item", "value", "rank"]
    return by_source.select(*_GROUP, F.lit("pair").alias("part"), *columns).union(by_term.select(*_GROUP, F.lit("term").alias("part"), *columns))
