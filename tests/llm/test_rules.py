import random
import re

import numpy as np
import pytest
from llm_helpers import ODD, docs, prose

from tidemark.llm import language, outliers, page_text, toxicity, winnowing
from tidemark.llm.queries import op5_language, op6_toxicity


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics_of_texts(spark):
    rng = random.Random(1)
    texts = [*ODD, *[prose(rng, rng.randint(1, 90)) for _ in range(10)], "a b c d a b c x a b c", "# * | <b> & 100%\n# * | <b> & 100%", "x y z " * 60, " ".join(prose(rng, 40).split() * 3)]
    got = sorted(outliers.statistics(docs(spark, texts, extra=True)).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got] == [plain_statistics(t) for t in texts]


def test_chi_squared_quantiles():
    for share, p, value in ((0.95, 1, 3.8415), (0.95, 4, 9.4877), (0.975, 2, 7.3778), (0.99, 5, 15.0863), (0.5, 3, 2.366)):
        assert abs(outliers.quantile(share, p) - value) < 1e-3


def test_estimates_withstand_outliers(spark):
    """A third of the rows far away moves neither centre nor spread; the same as numpy on the clean rows."""
    rng = np.random.default_rng(2)
    clean = rng.multivariate_normal([100, 5, 3, 2], np.diag([4.0, 1.0, 2.0, 1.0]) + 0.5, 2000)
    bad = rng.normal(300, 3, (900, 4))
    rows = [("g", *[int(round(v * outliers._UNIT)) for v in x]) for x in np.vstack([clean, bad])]
    frame = spark.createDataFrame(rows, "cell string, u0 long, u1 long, u2 long, u3 long").repartition(5)
    got = outliers.estimate(frame).first()
    assert np.allclose([got[f"c{i}"] for i in range(4)], clean.mean(axis=0), atol=0.25)
    lower = np.array([[got[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    assert np.allclose(lower @ lower.T, np.cov(clean.T) + np.eye(4), atol=0.9)
    again = outliers.estimate(frame.repartition(3)).first()
    assert again == got


def test_outliers_of_each_group(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(150)]
    junk = [" ".join(w + "###" for w in prose(rng, 80).split()) for _ in range(10)]
    df = docs(spark, [*texts, *junk, None, "short", "a b c " * 100], extra=True)
    got = {r.doc_id: r for r in outliers.judge(df).collect()}
    assert sum(got[i].kept for i in range(150)) >= 149
    assert not any(got[i].kept for i in range(150, 163)) and all(got[i].base_failed for i in (160, 161, 162))
    assert outliers.judge(docs(spark, [])).count() == 0
    assert outliers.judge(docs(spark, [prose(rng, 90)], lang=None)).first().kept


def test_repeated_lines_and_words_below_the_base_limits(spark):
    """A third to two thirds of the lines or a third of the words repeated, beside texts without repeats: the estimates reject what the base rule keeps."""
    rng = random.Random(13)
    clean = ["\n".join(prose(rng, 8) for _ in range(20)) for _ in range(100)]
    lines = ["\n".join([*(prose(rng, 8) for _ in range(20 - n)), *["la ti"] * n]) for n in (8, 10, 12, 14)]  # lines too short to repeat many words
    words = [" ".join([prose(rng, 120), *[prose(rng, 20)] * 3]) for _ in range(4)]
    got = {r.doc_id: r for r in outliers.judge(docs(spark, [*clean, *lines, *words])).collect()}
    assert not any(got[i].base_failed for i in range(108))
    assert sum(got[i].kept for i in range(100)) >= 98 and not any(got[i].kept for i in range(100, 108))


def test_language_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = op5_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "n_chars"), "doc_id").toPandas()
    tested = got[got.held_out & (got.n_chars > 100)]
    assert len(got) == 1000 and (tested.lang_pred == tested.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_of_odd_texts(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 30) if i % 2 else " ".join("zuwqxj"[i % 5 :] for _ in range(30)), "aa" if i % 2 else "bb") for i in range(60)]
    train = spark.createDataFrame([*rows, (98, None, "aa"), (99, "text", None), (97, "123", "cc")], "doc_id long, text string, lang string")
    model = language.train(train)
    df = docs(spark, [None, "", "123 !", prose(rng, 20), "zuwqxj zuwqxj"], extra=True)
    got = sorted(language.identify(df, model, "doc_id").collect(), key=lambda r: r.doc_id)
    assert [r.lang_pred for r in got] == ["und", "und", "und", "aa", "bb"] and all(0 <= r.score <= 1 for r in got)
    nothing = language.train(train.where("false"))
    assert {r.lang_pred for r in language.identify(df, nothing, "doc_id").collect()} == {"und"}
    assert language.identify(docs(spark, []), model, "doc_id").count() == 0


def test_machines_within_a_family():
    rng = np.random.default_rng(5)
    centres = {"en": 0, "de": 1, "fr": 2, "es": 3, "xx": 4}
    labels = np.array([x for x in centres for _ in range(40)], dtype=object)
    rows = rng.normal(0, 0.1, (200, language._DIMENSIONS + 1)).astype(np.float32)
    for i, x in enumerate(labels):
        rows[i, centres[x]] += 5
    model = language.Model(rows, labels)
    assert set(model.at) == {("germanic",), ("romance",), ("xx",), ("de", "en"), ("es", "fr")}
    signs = np.where(labels == "xx", 1.0, -1.0)
    assert ((rows @ language.train_svm(rows, signs) > 0) == (signs > 0)).all()


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = op6_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").toPandas()
    tested = got[got.held_out]
    toxic, clean = tested[tested.toxic == 1], tested[tested.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.85 and (clean.predicted == 0).mean() > 0.9
    rank = sum((a > clean.score).mean() + (a == clean.score).mean() / 2 for a in toxic.score) / len(toxic)
    assert rank > 0.95


def test_risk_without_negative_labels():
    """Unlabelled texts hold positives in the share of the prior; the fit tells the classes apart all the same."""
    rng = np.random.default_rng(6)
    positive = np.array([True] * 100 + [False] * 400)
    toxic = positive | (np.arange(500) < 180)
    rows, columns = [], []
    for i in range(500):
        for w in rng.choice(20, 5, replace=False):
            rows.append(i)
            columns.append(w)
        if toxic[i]:
            rows.append(i)
            columns.append(20)
    weights = toxicity.fit(np.array(rows), np.array(columns), positive, 21, prior=0.2)
    scores = np.bincount(rows, weights[columns], minlength=500) + weights[-1]
    assert ((scores > 0) == toxic).mean() > 0.97


def test_toxicity_of_odd_tables(spark):
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (77, 1, 1), (None, 0, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    df = docs(spark, [*ODD, None], extra=True)
    weights = toxicity.train(df, labels)
    assert all(0 <= r.score <= 1 for r in toxicity.score(df, weights, "doc_id").collect())
    assert toxicity.train(df, labels.where("false")) is None
    assert {r.score for r in toxicity.score(df, None, "doc_id").collect()} == {0.0}


def plain_hits(text, items, size=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, content in items:
        own = split(content)
        n = min(size, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(map(str, found))


def test_contamination_against_all_windows(spark):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.choice((3, 9, 10, 11, 25)))) for i in range(12)] + [(12, ""), (13, None), (14, "Two words"), (15, "two WORDS"), (16, "one")]
    texts = [*ODD]
    for _ in range(40):
        part = rng.choice(items)[1] or ""
        words = part.split()
        cut = words[rng.randint(0, 3) :][: rng.randint(1, 30)]
        texts.append(" ".join([prose(rng, rng.randint(0, 15)), *cut, "two words" if rng.random() < 0.2 else "", prose(rng, rng.randint(0, 15))]))
    benchmark = spark.createDataFrame([*items, (0, items[0][1]), (None, prose(rng, 20))], "item_id long, text string")
    df = docs(spark, texts, extra=True)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"] or []) for r in winnowing.contamination(df, benchmark).collect()}
    assert got == {i: plain_hits(t, items) for i, t in enumerate(texts)}
    clean = winnowing.decontaminate(df, benchmark)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {i for i, (_, n, _) in got.items() if not n}
    ranges: dict = {}
    for r in winnowing.spans(df, benchmark).collect():
        ranges[r.id] = ranges.get(r.id, 0) + r.end - r.start
    assert ranges == {i: n for i, (_, n, _) in got.items() if n}
    assert winnowing.contamination(df, benchmark.where("false")).where("n_hit > 0").count() == 0
    assert winnowing.contamination(docs(spark, []), benchmark).count() == 0
    twice = winnowing.contamination(df.union(df.where("doc_id = 20")), benchmark)
    assert twice.count() == len(texts) + 1


def test_marginals_against_all_states():
    rng = np.random.default_rng(8)
    parents, unary, pair = [-1, 0, 0, 1, 1, 2, 5], rng.normal(0, 1, 7), rng.normal(0, 1, (2, 2))
    weight, sums, edges = 0.0, np.zeros(7), np.zeros((7, 4))
    for state in range(128):
        y = [state >> i & 1 for i in range(7)]
        w = np.exp(sum(u * s for u, s in zip(unary, y, strict=True)) + sum(pair[y[parents[i]], y[i]] for i in range(1, 7)))
        weight += w
        sums += w * np.array(y)
        for i in range(1, 7):
            edges[i, 2 * y[parents[i]] + y[i]] += w
    got, joint = page_text.marginals(parents, unary.tolist(), pair)
    assert np.allclose(got, sums / weight) and np.allclose(joint, edges / weight)


@pytest.fixture(scope="module")
def model():
    return page_text.train(page_text.seed_pages())


def test_layouts_learned_from(model):
    for page, inside in page_text.seed_pages():
        unary = [sum(model[0][f] for f in x) for x in page_text.features(page)]
        p, _ = page_text.marginals(page.parents, unary, model[1])
        wrong = [t for n, t in page.blocks if (p[n] >= 0.5) != inside[n]]
        assert len(wrong) <= 1


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("<article><p>A &amp; B&nbsp;&#233; <b>bold</b>\n text<br>next<p>Two</article>", "A & B é bold text next\nTwo"),
        ("<body><nav><ul><li><a href=x>Menu</a></ul></nav><article><h1>T</h1><p>One<script>var a='<p>no</p>'</script><p>Two<style>p{}</style></article><footer>End</footer>", "T\nOne\nTwo"),
        ("<article><p>Left <!-- not <p>this</p> -->right</p></div></span><p>more</article>", "Left right\nmore"),
        ("<article><p>cut <!-- never ends", "cut"),
        ("<article><p>a &lt;b&gt; c</p><p hidden>no</p><ul><li>x<li>y</ul></article>", "a <b> c\nx\ny"),
    ],
)
def test_pages(model, html, text):
    assert page_text.extract(html, *model) == text


def test_pages_of_the_sample(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    strange = spark.createDataFrame([(900, "u", None), (901, "u", ""), (902, "u", "<" * 3000), (903, "u", "<div>" * 3000 + "deep")], pages.schema)
    trained = page_text.train_on(pages)
    got = {r.page_id: r.text for r in page_text.main_texts(pages.union(strange).withColumn("text", pages["url"]), trained, "page_id").collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(page_text.entities.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(x for x in blocks if x)
    assert got[900] == got[901] == ""
    assert page_text.main_texts(pages.where("false"), trained, "page_id").count() == 0


@pytest.mark.parametrize(
    "html, texts",
    [
        ('<article><h1>T</h1><p class="x>One two three.</p><p>Four <a href="u">five</a>.</p></article>', ["T", "One two three.", "Four five."]),
        ("<p title=\"a < b\" data-x='<b>no</b>'>yes</p>", ["yes"]),
        ("<p>1 < 2 and x</p><p class=\"y", ["1 < 2 and x"]),
        ("<p class='it's open>said</p>", ["said"]),
    ],
)
def test_quotes_that_nothing_closes(html, texts):
    assert [text for _, text in page_text.Page(html).blocks] == texts


@pytest.mark.parametrize("part", ['<p class="x>One two.', "<a ", "<p a='x\"y>z", "\"<p '"])
def test_a_page_of_open_quotes_takes_linear_time(part):
    import time

    def seconds(n):
        start = time.process_time()
        assert not any("<" in text for _, text in page_text.Page(part * n).blocks)
        return time.process_time() - start

    seconds(1_000)
    assert seconds(40_000) < 40 * seconds(4_000) + 1  # ten times the page; its square would be a hundred times


def test_language_predicts_each_text_once(spark):
    """Also where the prediction is filtered and kept; texts and other columns come back unchanged."""
    rows = [(i, None if i % 7 == 0 else "" if i % 7 == 1 else f"the house of number {i} and the sea " * (1 + i % 3), "en", f"x{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, found string")
    found = language.identify(df, language.train(df), *df.columns)
    kept = found.where("lang_pred <> 'und' AND score >= 0.25")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1
    assert sorted(tuple(r)[:4] for r in kept.collect()) == [r for r in rows if r[1]]
