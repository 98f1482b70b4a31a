"""Search, extraction, quality, the pipeline, and odd inputs of every operator."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import ann, decontam, hmm, html, packing, pii, quality, queries, secrets, simhash, suffixes
from tests.llm.conftest import FOLDER


def test_neighbours(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([r.embedding for r in rows], float)
    cosine = m @ m.T / np.linalg.norm(m, axis=1) / np.linalg.norm(m, axis=1)[:, None]
    got = {}
    for r in queries.op8_one_bit_neighbours(spark, FOLDER).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for k, i in enumerate(ids):
        if i % 50 == 0:
            s = np.where(ids == i, -9, cosine[k])
            best = np.lexsort((ids, -s))[:5]
            hits += len(set(ids[best]) & {v for v, _ in got[i].values()})
            assert all(abs(cosine[k][list(ids).index(v)] - s) < 1e-12 for v, s in got[i].values())
    assert hits >= 0.9 * 5 * len(got)


def test_neighbours_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (8, [float("inf"), 1.0]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("code", F.lit("x"))
    got = ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_codes_bound_the_product():
    rng = np.random.default_rng(8)
    v, q = rng.normal(size=(500, 64)), rng.normal(size=(20, 64))
    codes, factors, _ = ann.encode(v)
    guess, bound = ann.estimates(codes, factors, ann.encode(q)[2])
    exact = (q / np.linalg.norm(q, axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T
    assert codes.shape == (500, 8) and (np.abs(guess - exact) <= bound).mean() > 0.98


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href=x>Menu</a></li></ul>
</nav><div class="ad">Buy</div><article><h1>Head &amp; line</h1><p>One  <b>two</b>three<br>four<!-- no --><p>five<div class="ad">Buy</div>
<div class="comments"><p>I think</p></div><form><input>Mail</form>&#233;nd</article><aside>Side</aside><footer>Foot</footer>"""


def test_page_by_hand(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    trees = html.fit([r.html for r in pages.select("html").collect()] + [PAGE])
    assert html.extract([PAGE], trees) == ["Head & line One twothree four five énd"]
    assert html.extract(["", "just text", "<p>a<p>b"], None) == ["", "just text", "a b"]


def test_pages_equal_their_article(spark):
    import re
    from html import unescape

    rows = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in queries.op9_page_text(spark, FOLDER).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer|$)", rows[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"<!--.*?-->|</?b\b[^>]*>", "", inner, flags=re.S))
        assert r.text == re.sub(r"\s+", " ", unescape(plain)).strip() and r.n_chars == len(r.text)


@pytest.mark.parametrize("start, end", [
    ("<div class=post>", "</div>"), ("<div>", "</div>"), ("<div role=main>", "</div>"), ("<table><tr><td>", "</td></tr></table>"), ("", ""),
])
def test_pages_without_article_keep_their_text(spark, start, end):
    rows = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").orderBy("page_id").collect()]
    half = len(rows) // 2
    trees = html.fit(rows[:half])
    other = [h.replace("<article>", start).replace("</article>", end) for h in rows[half:]]
    assert html.extract(other, trees) == html.extract(rows[half:], trees)
    body = ["<html><body><p>One two</p><p>Three four</p></body></html>", "<p>One two<p>Three four", "<div>One two<br>Three four</div>"]
    assert html.extract(body, trees) == ["One two Three four"] * 3


@pytest.mark.parametrize("old, new", [
    ("<body>", '<body class="has-sidebar">'), ("<article>", '<article class="post comments-open">'),
    (("<article>", "</article>"), ('<div class="entry">', "</div>")), ("<p>", "<p title=it's>"),
])
def test_pages_keep_their_text_when_all_of_the_table_is_altered(spark, old, new):
    """Fitted and extracted on the same altered pages."""
    rows = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").orderBy("page_id").collect()]
    want = html.extract(rows, html.fit(rows))
    other = rows
    for a, b in zip(*((old, new) if isinstance(old, tuple) else ((old,), (new,)))):
        other = [h.replace(a, b) for h in other]
    assert other != rows
    got = html.extract(other, html.fit(other))
    assert [g == w for g, w in zip(got, want)].count(False) == 0


def test_one_page_in_ten_with_a_telling_body_class(spark):
    rows = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").orderBy("page_id").collect()]
    want = html.extract(rows, html.fit(rows))
    other = [h.replace("<body>", '<body class="has-sidebar">') if k % 10 == 0 else h for k, h in enumerate(rows)]
    assert html.extract(other, html.fit(other)) == want


def test_quotes_in_unquoted_values():
    page = "<p title=it's>Hello one</p><p>Don't go</p><p data-x=\"a>b\" y='c>d'>End</p>"
    nodes = html.parse(page)
    assert html.text_of(nodes, np.array([html.CONTENT] * len(nodes))) == "Hello one Don't go End"


def test_samples_do_not_depend_on_the_layout(spark):
    docs, pages = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "pages"))
    assert pii._sample(docs.repartition(3)) == pii._sample(docs.repartition(7)) != []
    rows = pages.select("page_id", "html")
    assert html._drawn(rows.repartition(2).unionAll(rows.limit(1)), 250) == html._drawn(rows.repartition(5), 250) != []


def test_role_main_counts_as_markup():
    page = "<body><div class=x>Top</div><div role=main><p>One</p><div class=ad>Buy</div></div></body>"
    nodes = html.parse(page)
    assert html.text_of(nodes, html.weak_roles(nodes)) == "One"
    assert html.weak_roles(html.parse("<body><div class='role main'><p>One</p></div></body>")) is None


def test_decoding_contradicts_nothing():
    nodes = html.parse(PAGE)
    roles = html.decode(nodes, np.log(np.random.default_rng(1).dirichlet([1, 1, 1], len(nodes))))
    for node, role in list(zip(nodes, roles))[1:]:
        assert roles[node.parent] != html.BOILERPLATE or role == html.BOILERPLATE
        assert roles[node.parent] != html.CONTENT or role != html.FRAME


def test_quality_on_rows_it_did_not_see(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where("doc_id % 2 = 0")
    scored = quality.score_quality(docs, seen).join(labels.where("doc_id % 2 = 1"), "doc_id")
    right = scored.select((F.col("keep") == ((F.col("quality") == 1) & (F.col("toxic") != 1))).cast("int").alias("r"))
    assert right.agg(F.avg("r")).first()[0] > 0.85
    assert quality.score_quality(docs, labels.limit(0)).where("keep").count() == docs.count()


def operators(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (3, "one two three")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    return {
        "pii": pii.pii_digest, "redact": pii.redact, "pack": lambda d: packing.pack(d, queries.tokenizer_path()),
        "leaks": lambda d: decontam.find_leaks(d, bench), "drop_leaks": lambda d: decontam.drop_leaks(d, bench),
        "repeats": suffixes.remove_repeats, "hmm": hmm.score, "quality": lambda d: quality.score_quality(d, labels),
        "keep_good": lambda d: quality.keep_good(d, labels), "simhash": simhash.simhash_components,
        "keep_first": simhash.keep_first, "secrets": secrets.secret_digest,
    }


ROWS = {"leaks": 8, "drop_leaks": 6, "keep_first": None, "keep_good": 10}


@pytest.mark.parametrize("name", ["pii", "redact", "pack", "leaks", "drop_leaks", "repeats", "hmm", "quality", "keep_good",
                                  "simhash", "keep_first", "secrets"])
def test_odd_rows_and_empty_tables(spark, odd_rows, name):
    run = operators(spark)[name]
    rows = run(odd_rows).collect()
    if name == "keep_first":
        # one of the empty texts, the three equal ones and the long ones; the row without id stays
        assert sorted((r.doc_id is None, r.doc_id) for r in rows) == [(False, 1), (False, 4), (False, 6), (False, 8), (True, None)]
    elif name == "pack":
        assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    else:
        assert len(rows) == ROWS.get(name, 10)
    assert run(odd_rows.limit(0)).count() == 0


def test_keep_first_goes_by_row(spark):
    """Rows that share a doc_id but not their text are different documents; copies without doc_id go but one."""
    text = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdef"}
    rows = [(7, text["a"]), (7, text["b"]), (7, text["c"]), (7, text["c"]), (3, text["c"]), (9, text["d"]), (9, text["d"]),
            *[(None, text["e"])] * 5, (None, text["f"]), (1, text["f"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("own"))
    kept = simhash.keep_first(df.repartition(3))
    assert kept.columns == df.columns and {r._row for r in kept.collect()} == {"own"}
    got = sorted((r.doc_id or 0, r.text[0]) for r in kept.collect())
    assert got == [(0, "e"), (0, "f"), (1, "f"), (3, "c"), (7, "a"), (7, "b"), (9, "d")]


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "near_duplicates", "benchmark_decontamination", "personal_data", "sequences"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns and docs.count() <= before.count()
        assert name != "personal_data" or docs.count() == before.count()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()} == ids
    leaked = {r.doc_id for r in queries.op3_benchmark_decontamination(spark, FOLDER).collect()}
    assert not ids & leaked
    assert not [r for r in docs.collect() if pii.base_spans(r.text or "")]
