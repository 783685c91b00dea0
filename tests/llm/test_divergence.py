import random
import re
from collections import Counter

from llm_helpers import DOCS, prose
from pyspark.sql import functions as F

from tidemark.llm import divergence


def expected(rows, top=200):
    counts, found_in, groups = {}, {}, set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        n = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
        counts.setdefault((lang, source), Counter()).update(n)
        found_in.setdefault(lang, Counter()).update(n.keys())
    out = []
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in found_in[lang].items() if n >= 3]
        sources = sorted(s for x, s in groups if x == lang)
        of = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        of[None] = {t: sum(of[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (n + 1) // (sum(c.values()) + len(kept)) for t, n in c.items()} for s, c in of.items()}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-((p[s][t] - p[None][t]) ** 2 // p[None][t]), t.encode(), t) for t in kept if of[s][t] and p[s][t] > p[None][t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1)]
    return sorted(out)


def test_audit_against_dense_counting(spark):
    rng = random.Random(31)
    rows = []
    for i in range(120):
        lang, source = rng.choice(["de", "fr", None, ""]), rng.choice(["hot", "hot", "b", "c", None, "d"])
        rows.append((f"{prose(rng, rng.randint(0, 60))} É1é don't A_B" if rng.random() < 0.9 else rng.choice([None, "", "123 --"]), lang, source))
    rows += [("same text again and again", "fr", "copies")] * 7 + [("lonely words here", "xx", "one"), ("", "xx", "two"), ("odd", "z\0z", "s"), ("odd", "z\0z", "s"), ("odd", "z\0z", "t")]
    rows += [("straße " * 40_000, "de", "long")]
    df = spark.createDataFrame([(i, t, x, s, None) for i, (t, x, s) in enumerate(rows)], DOCS)
    for name in ("tokens", "counts", "index", "item", "value", "rank", "term", "n", "p", "q", "terms", "total", "floor"):
        df = df.withColumn(name, F.lit(1))
    got = sorted(tuple(r) for r in divergence.audit(df.repartition(5)).collect())
    assert got == expected(rows)


def test_no_kept_term_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", "en", "x", None), (2, None, "en", "y", None)], DOCS)
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert divergence.audit(df.where("doc_id = 0")).count() == 0


def test_terms_stop_at_the_rank(spark):
    rng = random.Random(2)
    rows = [(prose(rng, 200), "en", s) for s in "ab" for _ in range(10)]
    df = spark.createDataFrame([(i, *r, None) for i, r in enumerate(rows)], DOCS)
    got = sorted(tuple(r) for r in divergence.audit(df, top=5).collect())
    assert got == expected(rows, 5)


def test_shares_and_sums_are_exact_at_any_size(spark):
    counts = [0, 5, 8_999_999_999, 9_000_000_000, 4 * 10**13]
    rows = spark.createDataFrame([(n, 10**14, 77) for n in counts], "n long, total long, terms long")
    got = {r.n: r.p for r in rows.select("n", divergence._share("n").alias("p")).collect()}
    assert got == {n: 1 + (n + 1) * 10**9 // (10**14 + 77) for n in counts}
    values = [10**18, -(10**18), 4 * 10**18, 4 * 10**18, 4 * 10**18, -1, -(2**32), 2**32 - 1, 0]
    one = spark.createDataFrame([(v,) for v in values], "v long").agg(divergence._exact_sum("v").alias("s")).first()
    assert int(one.s) == sum(values)
