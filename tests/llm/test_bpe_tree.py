import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ODD, docs, prose
from pyspark.sql import functions as F
from test_tokens import FILES, PIECES
from tokenizers import Tokenizer

from tidemark.llm import bpe_tree, tokens

PATH = FILES["spaces"]


@pytest.fixture(scope="module")
def made():
    return bpe_tree.TreeEncoder(tokens.definition_of(PATH)), Tokenizer.from_file(PATH)


def same(made, text, leaf):
    tree, library = made
    ids = tree.encode(text, leaf)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert tree.text(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*PIECES, "'re", "'ve", "ll", "r", "v", "<|endof", "text|>", "   ", "\n\n"]), max_size=30).map("".join), st.integers(1, 9))
def test_leaves_cut_anywhere(made, text, leaf):
    same(made, text, leaf)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.integers(1, 7))
def test_any_text(made, text, leaf):
    same(made, text, leaf)


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(["ab", "the", "aeiou", "0123", "!?.-", "'!st", "=-", "日本語の", "é", "\n ", "\n\t", "xX", "😀👍"]), st.integers(0, 1 << 30), st.integers(1, 400), st.integers(1, 60))
def test_runs_without_joints(made, alphabet, seed, n, leaf):
    rng = random.Random(seed)
    same(made, "".join(rng.choice(alphabet) for _ in range(n)), leaf)


@pytest.mark.parametrize("piece", ["a", "ab", "=", "7", "the", "日本", "\n", " ", "word", "'"])
def test_long_runs(made, piece):
    same(made, "start " + piece * 5000 + " end", 512)


def test_windows_stay_small_in_a_long_run(made, monkeypatch):
    tree, library = made
    seen = []
    plain = tree._ids
    monkeypatch.setattr(tree, "_ids", lambda text: seen.append(len(text)) or plain(text))
    rng = random.Random(5)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(1 << 15))
    ids = tree.encode(text, 4096)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(n for n in seen if n != 4096) < 1000


def expected(texts):
    library = Tokenizer.from_file(PATH)
    out = {}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    return out


def test_round_trip_with_long_texts_over_tasks(spark):
    rng = random.Random(6)
    long = prose(rng, 900)
    texts = [*ODD, *[prose(rng, rng.randint(1, 300)) for _ in range(30)], long, long, long + "<|endoftext|>" + "q" * 3000, "日本" * 900]
    for segment in (64, 1000):
        df = docs(spark, texts, extra=True).withColumn("node", F.col("doc_id")).withColumn("ids", F.lit("x"))
        got = {r.doc_id: tuple(r)[1:] for r in bpe_tree.round_trip(df, PATH, "doc_id", segment=segment, leaf=40).collect()}
        assert got == expected(texts)


def test_empty_tables_and_repeated_rows(spark):
    assert bpe_tree.round_trip(docs(spark, []), PATH, "doc_id").count() == 0
    df = docs(spark, ["one two", "y" * 200])
    assert bpe_tree.round_trip(df.union(df).union(df), PATH, "doc_id", segment=100).count() == 6


def test_digests_of_many_tokens(made):
    tree, _ = made
    for text in ("é " * 90_000, "日" * 90_000, "w" * 200_000):
        ids = tree.encode(text)
        listed, decoded = tree.digests(ids)
        assert listed == hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
        assert decoded == hashlib.sha256(text.encode()).hexdigest()
