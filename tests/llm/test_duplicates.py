import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from llm_helpers import ODD, docs, prose
from pyspark.sql import functions as F

from tidemark.llm import fuzzy_lines, golay, simhash
from tidemark.llm.components import components
from tidemark.session import materialise as plain


def grouped(n, links):
    least = list(range(n))
    for _ in range(n):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize("seed", range(2))
def test_components_against_relaxation(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(60 + i, 61 + i) for i in range(39)] + [(100, 100), (101, 102), (102, 101)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = grouped(103, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: want[i] for i in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_two_bits_apart_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    other = words.copy()
    for _ in range(2):
        other ^= 1 << rng.integers(0, 23, len(words))
    sets = []
    for x in (words, other):
        at, key = golay.keys(x)
        sets.append([set(key[at == i].tolist()) for i in range(len(x))])
        assert {len(s) for s in sets[-1]} <= {1, 6}
    assert all(a & b for a, b in zip(*sets, strict=True))


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(rng, n_texts, n_copies, words=300):
    out = []
    for _ in range(n_texts):
        base = prose(rng, words).split()
        out.append(" ".join(base))
        for _ in range(n_copies):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("most", [2, 16])
def test_groups_against_all_pairs(spark, most):
    rng = random.Random(4)
    texts = [*ODD, *near_copies(rng, 6, 8), *["exact copy of a text"] * 5]
    prints = [plain_fingerprint(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = grouped(len(texts), links)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.groups(docs(spark, texts, extra=True), words_in_shingle=4, most=most).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in range(len(texts))}


def test_one_document_of_each_group_stays(spark):
    df = docs(spark, ["a b c d e f", "a b c d e f", "something else is here", None, "", "a b c d e f"])
    twice = df.union(df.where("doc_id = 2"))
    kept = simhash.deduplicate(twice)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    assert simhash.deduplicate(docs(spark, [])).count() == 0


def test_rows_without_an_id_or_with_a_shared_one_stay(spark):
    rng = random.Random(12)
    texts = [prose(rng, 80) for _ in range(6)]
    df = docs(spark, [*texts, texts[0]])
    no_ids = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert sorted(r.text for r in simhash.deduplicate(no_ids).collect()) == sorted(texts)
    one_id = df.withColumn("doc_id", F.lit(7).cast("long"))
    assert sorted(r.text for r in simhash.deduplicate(one_id).collect()) == sorted(texts)
    assert [r.doc_id for r in simhash.deduplicate(no_ids.where(F.col("text") == texts[0]).union(one_id.where(F.col("text") == texts[0]))).collect()] == [7]


def shingles(line):
    return {line[i : i + 8] for i in range(max(1, len(line) - 7))}


def lines_left(texts, least=0.8):
    """Brute force: which (document, line) stays."""
    places = [(d, i, x.strip(" \t\r\x0b\x0c")) for d, t in enumerate(texts) for i, x in enumerate((t or "").split("\n"))]
    places = [p for p in places if p[2]]
    sets = [shingles(p[2]) for p in places]
    links = []
    for i in range(len(places)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if places[i][2] == places[j][2] or common >= least * (len(sets[i]) + len(sets[j]) - common):
                links.append((i, j))
    least_of = grouped(len(places), links)
    return {places[i][:2] for i in range(len(places)) if least_of[i] != i}


@pytest.mark.parametrize("most", [2, 16])
def test_fuzzy_lines_against_all_pairs(spark, most):
    rng = random.Random(5)
    base = [prose(rng, 25) for _ in range(8)]
    texts = [*ODD]
    for _ in range(25):
        chosen = [rng.choice(base) for _ in range(3)] + [prose(rng, 12)]
        chosen[0] = chosen[0].replace("ta", "to", 1)
        texts.append("\n".join(chosen))
    dropped = {(r.id, r.line_no) for r in fuzzy_lines.repeated(docs(spark, texts, extra=True), most=most).collect()}
    want = lines_left(texts)
    assert len(want) > 30 and len(dropped ^ want) <= 0.03 * len(want)


def drifting(rng, n_chains, length):
    """Chains of lines: each is like the one before it and unlike those further off."""
    out = []
    for _ in range(n_chains):
        words = prose(rng, 24).split()
        for i in range(length):
            words[5 * i % len(words)] = f"{prose(rng, 1)[:6]}{i}"
            out.append(" ".join(words))
    rng.shuffle(out)
    return out


def test_every_link_within_a_crowded_key(spark, monkeypatch):
    """All lines share one key, so nothing may be missed: components are those of brute force."""
    monkeypatch.setattr(fuzzy_lines, "_buckets", lambda distinct: distinct.select("key", F.lit(1).cast("long").alias("bucket")))
    texts = [*drifting(random.Random(8), 2, 30), *drifting(random.Random(10), 8, 1)]
    df = docs(spark, texts)
    dropped = {(r.id, r.line_no) for r in fuzzy_lines.repeated(df).collect()}
    want = lines_left(texts)
    assert len(want) > 50 and dropped == want


def test_short_lines_are_candidates(spark):
    """Lines of 16 characters that differ in the last have similarity 0.8: 0.985 of such pairs share a key."""
    rng = random.Random(11)
    starts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ,.") for _ in range(13)) for _ in range(1500)]
    texts = [f"x{s}y{end}" for s in starts for end in "pq"]
    keys = fuzzy_lines._buckets(fuzzy_lines.signatures(docs(spark, texts)).select("key", "keys", "id").withColumn("key", F.col("id")))
    shared = keys.groupBy("bucket", F.floor(F.col("key") / 2).alias("pair")).agg(F.countDistinct("key").alias("n")).where("n = 2")
    assert shared.select("pair").distinct().count() > 0.97 * len(starts)


@pytest.mark.parametrize("n", [600, 3000])
def test_a_crowd_of_unlike_lines_takes_a_fixed_number_of_passes(spark, monkeypatch, n):
    """One template with ends of its own for every line, and two ends that are alike: nothing else goes."""
    rng = random.Random(13)
    template = prose(rng, 30)[:60]
    texts = [template + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(25)) for _ in range(n)]
    texts += [texts[7] + "!", texts[n // 2][:-1] + "?"]
    passes = []
    monkeypatch.setattr(fuzzy_lines, "materialise", lambda df, name, **how: (passes.append(name), plain(df, name, **how))[1])
    monkeypatch.setattr(fuzzy_lines, "BLOCK", 1 << 14)  # several blocks a key
    dropped = {(r.id, r.line_no) for r in fuzzy_lines.repeated(docs(spark, texts)).collect()}
    assert dropped == {(n, 0), (n + 1, 0)} and len(passes) == 12


@pytest.mark.parametrize("seed", range(3))
def test_blocks_against_every_pair(seed):
    rng = random.Random(seed)
    lines = []
    for _ in range(6):
        base = prose(rng, rng.randint(1, 30))
        lines += [base] + [base.replace(rng.choice("aeio"), "u", rng.randint(1, 3)) + "x" * rng.randint(0, 4) for _ in range(8)]
    lines = sorted({*lines, "a", "ab", "é日本語テキスト", "x" * 200, "x" * 300})
    rows = [(x, x, asks) for i, x in enumerate(lines) for asks in ((False, True) if i % 3 else (False,))]
    got = fuzzy_lines.block_links(pd.DataFrame(rows, columns=["key", "line", "asks"]), 0.8)
    sets = [shingles(x) for x in lines]
    near = [(i, j) for i in range(len(lines)) for j in range(len(lines)) if i != j and i % 3 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    at = {x: i for i, x in enumerate(lines)}
    found = [(at[a], at[b]) for a, b in zip(got["a"], got["b"], strict=True)]
    assert near and set(found) <= set(near) and grouped(len(lines), found) == grouped(len(lines), near)


def test_lines_of_rows_without_an_id_and_of_long_texts(spark):
    rng = random.Random(15)
    own = [prose(rng, 12) for _ in range(4)]
    df = docs(spark, [f"{own[0]}\n{own[1]}", f"{own[2]}\n{own[1]}", f"{own[3]}\n{own[1]}"])
    no_ids = df.withColumn("doc_id", F.when(F.col("doc_id") == 0, -1).when(F.col("doc_id") == 2, 5))
    left = {r.text: r.doc_id for r in fuzzy_lines.remove_repeated(no_ids).collect()}
    assert left == {own[0]: -1, f"{own[2]}\n{own[1]}": None, own[3]: 5}  # the row without an id is the first
    many = "\n".join(["the same line over and over again"] * 100_000 + [own[0]])
    (row,) = fuzzy_lines.remove_repeated(docs(spark, [many])).collect()
    assert row.text == f"the same line over and over again\n{own[0]}" and (row.n_lines, row.n_removed) == (100_001, 99_999)


def test_repeated_lines_go_and_the_rest_stays(spark):
    long = "a passage that stands in several documents, word for word, and then goes on for a while"
    texts = [f"first\n{long}\n\nlast", f"{long}.", f"own line\n{long}", None, "", "\n \n"]
    got = sorted(fuzzy_lines.remove_repeated(docs(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in got] == [texts[0], "", "own line", None, "", "\n \n"]
    assert [r.n_removed for r in got] == [0, 1, 1, 0, 0, 0] and [r.n_lines for r in got] == [4, 1, 2, 0, 1, 3]
    assert fuzzy_lines.remove_repeated(docs(spark, [])).count() == 0
