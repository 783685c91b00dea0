import random

from llm_helpers import docs, prose
from test_duplicates import grouped, near_copies, plain_fingerprint

import corpus_pipeline
from tests_data import benchmark_at


def test_each_stage_takes_effect(spark, tmp_path):
    rng = random.Random(9)
    item = prose(rng, 30)
    benchmark_at(spark, tmp_path, [(0, item)])
    clean = [prose(rng, 150) for _ in range(20)]
    passage = prose(rng, 60)
    changed = clean[0].split()
    changed[70] = "different"
    texts = [*clean, clean[1], " ".join(changed), f"{clean[2]}\n{passage}", f"{prose(rng, 100)}\n{passage}", f"{prose(rng, 100)} {item}", "123 456", None, ""]
    df = docs(spark, texts)
    columns = df.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = df
        df = stage(spark, df, str(tmp_path))
        if name != "packing":
            assert df.columns == columns and df.dtypes == before.dtypes
            kept[name] = {r.doc_id: r.text for r in df.collect()}
    assert set(kept["language identification"]) == set(range(25))
    lines = kept["line deduplication"]
    assert 20 not in lines and 21 not in lines and lines[22] == passage and passage not in lines[23]
    assert set(range(20)) <= set(kept["SimHash near-duplicates"])
    assert 24 in kept["SimHash near-duplicates"] and 24 not in kept["benchmark decontamination"]
    assert set(range(20)) <= set(kept["benchmark decontamination"])
    pieces = df.collect()
    assert {r.doc_id for r in pieces} == set(kept["benchmark decontamination"])


def test_one_of_each_group_of_fingerprints_stays(spark, tmp_path):
    """Against all pairs: the least id of each group of texts within four bits, over several links."""
    rng = random.Random(14)
    texts = near_copies(rng, 12, 4, words=250)
    prints = [plain_fingerprint(t) for t in texts]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    least = grouped(len(texts), linked)
    kept = {r.doc_id for r in corpus_pipeline.deduplicate_documents(spark, docs(spark, texts), str(tmp_path)).collect()}
    assert kept == {i for i in range(len(texts)) if least[i] == i} and 12 <= len(kept) < 50


def test_empty_documents(spark, tmp_path):
    benchmark_at(spark, tmp_path, [])
    docs(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
