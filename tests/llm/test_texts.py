"""Main texts, toxicity, quality and the pipeline."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import cotraining, toxicity
from llm.mainhtml import main_text, main_texts
from llm.shared import table

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &amp; simple\n text", "plain & simple text"),
    ("<nav>Menu</nav><article><h1>Head</h1><p>One <b>bo</b>ld.<br>Two</article><footer>&copy; x</footer>", "Head One bold. Two"),
    ("<div class=ad>buy now<article><p>hi there</article>", "hi there"),
    ("<body><header>Site</header><main><p>a&nbsp;b<script>var t='</p>';</script> c</p><aside>s</aside><section id='comments'><article>c1</article></section></main>", "a b c"),
    ("<div id='menu'><a>x</a></div><div id='content'><p>Long enough text stands here, really.</p><p>Short.</p></div><div class='sidebar'>y</div>", "Long enough text stands here, really. Short."),
    ("<article><p>Text</p><form>mail <input></form><div class='cookie-notice'>ok?</div><style>p{}</style></article>", "Text"),
    ("<nav>only menu</nav>", ""), ("<p>unclosed <div>mess</p></div></span>", "unclosed mess"), ("<article></article>", ""),
])
def test_main_text(html, text):
    assert main_text(html) == text


LONG = "A sentence of the article that goes on for quite a while. " * 12


@pytest.mark.parametrize("html, text", [
    (f"<article><h1>Title</h1><div class='no-share'><p>{LONG}</p></div></article>", f"Title {LONG}"),
    (f"<article class='has-sidebar'><h1>Title</h1><div class='widget body'><p>{LONG}</p><div class='share'>Share this</div></div></article>", f"Title {LONG}"),
    (f"<article><p>{LONG}<span class='advert'>Buy <b>now</b></span>End.</p><p><span class=ad>never closed</p><p>More.</p></article>", f"{LONG}End. More."),
    (f"<main><article><p>A teaser.</p></article><article><p>{LONG}</p></article></main>", LONG),
    (f"<div><h1>Title</h1><p>Intro</p><blockquote>{LONG}</blockquote></div>", f"Title Intro {LONG}"),
    (f"<div><section><p>Short part.</p></section><section><p>{LONG}</p></section></div>", f"Short part. {LONG}"),
    (f"<div><pre>x = 1</pre><ul><li>{LONG}</li></ul></div>", f"x = 1 {LONG}"),
    (f"<div class='page has-sidebar'><div><p>{LONG}</p><p>End.</p></div><div class='sidebar'>Other things</div></div>", f"{LONG} End."),
    (f"<div class='no-share form'><p>{LONG}</p><div class='cookie-notice'>ok?</div></div>", LONG),
    (f"<div><a>Home</a> <a>News</a></div><div><h1>Title</h1><div>{LONG}</div></div>", f"Title {LONG}"),
])
def test_whole_articles_in_plain_containers(html, text):
    assert main_text(html) == text.strip().replace("  ", " ")


def test_long_and_nested_pages():
    deep = "<div>" * 3000 + "<article><p>core</p></article>" + "</div>" * 3000
    assert main_text(deep) == "core"
    assert main_text("<div>x" * 30_000) == " ".join("x" * 30_000)
    assert main_text("<div>x</p></ul>" * 30_000) == " ".join("x" * 30_000)
    assert len(main_text("<article>" + "<p>word word</p>" * 20_000 + "</article>")) == 20_000 * 10 - 1


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert sorted(map(str, main_texts(pages).collect())) == sorted(map(str, main_texts(pages).collect()))
    assert {tuple(r) for r in main_texts(pages).collect()} == {(1, "u", "a", 1), (None, None, "", 0)}
    assert main_texts(pages.where("false")).count() == 0


@pytest.mark.parametrize("text, folded", [
    ("ID10T", "idiot"), ("m0r0n!", "moron "), ("іdіоt", "idiot"), ("ｓｃｕｍ", "scum"), ("s\u200bcum", "scum"), ("loser", "ioser"), ("NO!! WAY", "no  way"), ("réeux", "réeux"), (None, ""),
])
def test_folding(text, folded):
    assert toxicity.fold(text) == folded


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    plain = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    bad = ["vilewort", "grubface", "dimwick"]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(plain, k=60)
        toxic, junk = i % 5 == 0, i % 7 == 0
        if toxic:
            words[rng.randrange(60)] = rng.choice(bad).replace("i", rng.choice("i1"))
            words[rng.randrange(60)] = rng.choice(bad).upper()
        text = " ".join(words)
        if junk:
            text = text.upper().replace(" ", "!! ")
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
        if i % 2 == 0:
            labels.append((i, 0 if junk else 1, int(toxic)))
    rows += [(600, None, None, None, None), (601, "", "en", "src0", 0), (None, "alpha beta", "en", "src0", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("clash"))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark, labelled):
    docs, labels = labelled
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    right = [r["predicted"] == int(r["doc_id"] % 5 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 600]
    assert sum(right) / len(right) > 0.98
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (600, 601, None))
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and 470 < kept.count() < 490
    assert {r["predicted"] for r in toxicity.toxicity_scores(docs, labels.where("false")).collect()} == {0}
    assert toxicity.toxicity_scores(docs.where("false"), labels).count() == 0


def test_exception_phrases():
    model = toxicity.Model({"ciown ": 3.0}, frozenset(["ciown fish"]), (0.0, 0.0, 0.0, 0.0))
    hits = lambda t: toxicity._hits(toxicity.fold(t), model, model.automaton())
    assert hits("a clown fish swims") == (0.0, 0.0) and hits("you clown. go") == (3.0, 3.0)


def test_quality(spark, labelled):
    docs, labels = labelled
    got = cotraining.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    right = [r["kept"] == (r["doc_id"] % 7 != 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 600]
    assert sum(right) / len(right) > 0.97
    assert cotraining.quality_scores(docs.where("false"), labels).count() == 0
    assert {r["score"] for r in cotraining.quality_scores(docs, labels.where("false")).collect()} == {0.5}


@needs_data
def test_held_out_accuracy(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    for scores, label in ((toxicity.toxicity_scores(docs, labels), "toxic"), (cotraining.quality_scores(docs, labels), "quality")):
        share = scores.where("held_out").join(labels, "doc_id").select(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
        assert share > 0.9


@needs_data
def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SF).cache())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
    assert all(df.columns == docs.columns for df in seen[1:-1])
    counts = [df.count() for df in seen]
    assert counts[0] >= counts[1] == counts[2] >= counts[3] > 0
    assert {r[0] for r in seen[-1].select("doc_id").collect()} == {r[0] for r in seen[4].select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SF).count() == counts[-1]
    assert all(stage(spark, df.where("false"), SF).count() == 0 for (_, stage), df in zip(corpus_pipeline.STAGES, seen))
