from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents, rows
from weftline.llm import gru, hash_forest, language_model, queries
from weftline.llm.html_extract import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href=x>Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy now</div><article><h1>A  title &amp; more</h1><p><b>First line<br><p>Second&nbsp;para with
 a break &lt;tag&gt; &#233;.</p><div class="share-bar">Share this</div><aside>Aside</aside><form>Mail <input></form><p>x</p></article>
<section id="comments"><p>Reader: a very long comment that is no part of the article at all, as everyone can see.</p></section>
<footer>&copy; me</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE) == "A title & more\nFirst line\nSecond para with a break <tag> é.\nx"


def test_page_without_marks_uses_the_ratios():
    page = "<body>" + "<a href=x>l</a><br>" * 12 + "".join(f"<p>{'long text of the story ' * 12}{i}</p>" for i in range(5)) + "<a href=y>z</a><br>" * 12
    assert main_text(page).count("\n") == 4 and "story 4" in main_text(page)


def test_ratios_decide_inside_an_article():
    story = [f"{'a sentence of the story ' * 8}{i}" for i in range(8)]
    junk = [f"<div><a href=/{i}><i>Go</i></a> <b>x</b></div>" for i in range(12)]
    page = "<article>" + "".join(f"<p>{t}</p>" for t in story[:4]) + "<ul><li><a href=/r>A linked reference</a></li></ul>"
    page += "".join(f"<p>{t}</p>" for t in story[4:]) + "".join(junk) + "</article>"
    assert main_text(page).split("\n") == story[:4] + ["A linked reference"] + story[4:]


STORY = [f"{'a sentence of the story ' * 8 * (i % 3 + 1)}{i}" for i in range(6)]


def around(middle, article=""):
    """A page whose article has six long paragraphs before and after what is given."""
    story = "".join(f"<p>{t}</p>" for t in STORY)
    return f"<body><article{article}>{story}{middle}{story}</article></body>"


def test_a_table_of_short_cells_stays():
    rows = [[f"a{i}", str(i)] for i in range(12)]
    table = "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    assert main_text(around(table)).split("\n") == STORY + [c for r in rows for c in r] + STORY


@pytest.mark.parametrize("length", [1, 12])
@pytest.mark.parametrize("name", ["Reference {}", "{} Smith, On the matter of the story"])
def test_linked_references_at_the_end_stay(name, length):
    names = [name.format(i) for i in range(15)]
    story = [t * length for t in STORY]
    page = "".join(f"<p>{t}</p>" for t in story) + "<ul>" + "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(names)) + "</ul>"
    assert main_text(f"<article>{page}</article>").split("\n") == story + names


@pytest.mark.parametrize("element", ['h2 class="section-header"', 'div class="side-by-side"', 'section id="social-history"',
                                     'div class="page-header-image"', 'div class="post has-sidebar"', 'div class="entry-content share"',
                                     'div class="no-comments"', 'pre class="code"'])
def test_names_that_only_hold_a_word_stay(element):
    kept = main_text(around(f"<{element}>Kept <span class=text>words</span></{element.split()[0]}>"))
    assert kept.split("\n") == STORY + ["Kept words"] + STORY


@pytest.mark.parametrize("element", ["div class=article-comments", "div class=post-sidebar", "div class=content-ad", "div class=main-footer",
                                     "div class=share-bar", "div class='box relatedPosts'", "div id=comment_12", "div role=navigation",
                                     "section class=ad-728", "div class='article comments'", "div class=cookie-notice"])
def test_names_that_end_in_a_word_go(element):
    assert main_text(around(f"<{element}><p>{STORY[0]}</p></{element.split()[0]}>")).split("\n") == STORY + STORY


def test_highlighted_code_keeps_its_comments():
    assert "x = 1 # why" in main_text(around('<pre>x = 1 <span class="comment"># why</span></pre>'))


@pytest.mark.parametrize("card", ["<article class=card><h3>Another</h3><p>teaser</p></article>",
                                  "<main><p>short</p></main>"])
def test_the_marked_element_with_most_text_is_the_article(card):
    assert main_text(card + around("")).split("\n") == STORY + STORY
    assert main_text(around("") + card).split("\n") == STORY + STORY
    inner = "".join(f"<p>{t}</p>" for t in STORY)
    page = f"<main><h1>Title</h1><article>{inner}</article><article class=card><p>teaser</p></article></main>"
    assert main_text(page).split("\n") == ["Title", *STORY]


def test_bare_links_go_at_an_end_or_without_other_text():
    junk = "".join(f"<div><a href=/{i}><i>Go</i></a> <b>x</b></div>" for i in range(12))
    bare = "".join(f"<div><a href=/{i}><i>Go</i></a></div>" for i in range(12))
    story = "".join(f"<p>{t}</p>" for t in STORY)
    assert main_text(f"<article>{junk}{story}</article>").split("\n") == STORY
    assert main_text(around(junk)).split("\n") == STORY + ["Go x"] * 12 + STORY
    assert main_text(around(bare)).split("\n") == STORY + STORY


def test_an_article_in_a_layout_table():
    page = f"<table><tr><td><a href=/>Home</a></td><td>{around('<table><tr><td>1</td></tr></table>')}</td></tr></table>"
    assert main_text(page).split("\n") == STORY + ["1"] + STORY


def by_patterns(html):
    """The text of a page of the given table by plain patterns: what the article element holds, cut at its blocks."""
    found = re.search(r"<article>(.*?)</article>", html, re.S)
    blocks = re.split(r"</?(?:p|h\d|br|div|ul|ol|li|section)\b[^>]*>", found.group(1)) if found else []
    texts = [re.sub(r"\s+", " ", unescape(re.sub(r"<!--.*?-->|<[^>]+>", "", b, flags=re.S))).strip() for b in blocks]
    return "\n".join(t for t in texts if t)


def test_given_pages_against_plain_patterns(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/../sf0.01/pages.parquet").collect()}
    out = queries.QUERIES["op1_tag_ratio_text"](spark, f"{sf}/../sf0.01").collect()
    assert len(out) == len(pages) > 0
    assert [r["page_id"] for r in out if r["text"] != by_patterns(pages[r["page_id"]])] == []


def test_empty_and_repeated_pages(spark):
    frame = spark.createDataFrame([(1, PAGE), (1, PAGE), (2, "")], "page_id long, html string")
    texts = [r["t"] for r in frame.select(extract(F.col("html")).alias("t")).collect()]
    assert texts[0] == texts[1] == main_text(PAGE) and texts[2] == ""
    assert frame.limit(0).select(extract(F.col("html")).alias("t")).collect() == []


@pytest.mark.parametrize("head", ["", "<title>T</title><meta charset=x>", "<script>x</script><noscript><link href=x>",
                                  "<template><p>t</p></template><style>p{}</style>"])
def test_head_without_its_end_tag(head):
    assert main_text(f"<html><head>{head}<body><p>one</p><p>two</p></body></html>") == "one\ntwo"
    assert main_text(f"<html><head>{head}<p>one</p>") == "one"
    assert main_text(f"<html><head>{head}</head><body><p>one</p>") == "one"


@pytest.mark.parametrize("count", [10, 20, 30, 60, 100])
@pytest.mark.parametrize("menu", [0, 12])
def test_unmarked_pages_keep_every_paragraph(count, menu):
    rng = np.random.default_rng(count + menu)
    story = [("of the story " * 60)[:int(n)].strip() + f" {i}." for i, n in enumerate(rng.integers(40, 601, count))]
    links = lambda n, to: "".join(f"<div><a href=/{to}{i}>{to} {i}</a></div>" for i in range(n))
    page = "<body>" + links(menu, "menu") + "".join(f"<p>{t}</p>" for t in story) + links(5 if menu else 2, "foot")
    assert main_text(page).split("\n") == story


@pytest.mark.parametrize("html", [None, "", "   ", "<p>", "</p></div>", "<script>x", "<!-- <p>x</p> -->", "<![CDATA[x]]>"])
def test_pages_without_text(html):
    assert main_text(html) == ""


def test_text_right_in_a_head_ends_it():
    assert main_text("<head><title>T</title> \n words of the page") == "words of the page"


def test_broken_and_long_pages():
    assert main_text("plain text only") == "plain text only"
    assert main_text("<p>one<p>two <b>bold</i> end") == "one\ntwo bold end"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    words = "word " * 50_000
    assert main_text(f"<article><p>{words}</p></article>") == words.strip()


def test_pages_query(spark, sf):
    out = queries.QUERIES["op1_tag_ratio_text"](spark, sf)
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = out.collect()
    assert len(found) == len(pages) and all(r["text"] == main_text(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in found)
    odd = spark.createDataFrame([(1, None, "x"), (None, PAGE, "x")], "page_id long, html string, text string")
    assert sorted(r["t"] for r in odd.select(extract(F.col("html")).alias("t")).collect())[0] == ""


def vectors(n=900, seed=2, dim=16):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    x[100:300] = x[100]  # a vector that very many rows share
    return x * np.random.default_rng(seed + 1).uniform(0.5, 2, (n, 1))[np.r_[0:100, [100] * 200, 300:n]]


def nearest(x, ids, query):
    scores = x @ x[query]
    return [int(ids[i]) for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]][:20]


def test_search_finds_the_nearest(spark):
    x = vectors()
    ids = np.arange(len(x))
    frame = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<double>")
    out = hash_forest.search(frame, frame.filter("vec_id % 20 = 0")).toPandas()
    hits = total = 0
    for q, part in out.groupby("query_id"):
        part = part.sort_values("rank")
        assert list(part["rank"]) == list(range(1, 21)) and q not in set(part["vec_id"])
        assert np.allclose(part["score"], x[part["vec_id"]] @ x[q])
        want = nearest(x, ids, q)
        hits, total = hits + len(set(want) & set(part["vec_id"])), total + 20
        if 100 <= q < 300:  # ties go to the smaller ids
            assert list(part["vec_id"]) == want
    assert hits / total > 0.9


def test_recall_on_the_given_table(spark):
    out = queries.QUERIES["op2_hash_prefix_forest"](spark, "/root/testdata/sf0.1").toPandas()
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    at = {int(i): k for k, i in enumerate(ids)}
    hits = sum(len(set(nearest(x, ids, at[q])) & set(part["vec_id"])) for q, part in out.groupby("query_id"))
    assert hits / len(out) >= 0.9 and out["query_id"].nunique() == (ids % 20 == 0).sum()


def test_a_search_is_deeper_first():
    x = vectors(400, 5)
    sides = hash_forest.planes(x.shape[1])
    forest = hash_forest.Forest.build(hash_forest.strings(x, sides, float(np.linalg.norm(x, axis=1).max())))
    codes = hash_forest.strings(x[:5], sides, None)
    few, many = list(forest.candidates(codes, 10)), list(forest.candidates(codes, 300))
    assert all(set(a) <= set(b) and len(a) < len(b) for a, b in zip(few, many))


def test_search_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [1.0, 1.0]), (20, [-1.0, 0.0]), (7, []), (40, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("v", F.lit("x")).withColumn("ids", F.lit(1))
    out = hash_forest.search(frame, frame.filter("vec_id % 20 = 0")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(out)] == [
        (0, 1, 1, 0.5), (0, 2, 20, -1.0), (20, 1, 1, -0.5), (20, 2, 0, -1.0)]
    assert hash_forest.search(frame.filter("false"), frame.filter("false")).count() == 0


def plain_base(data, held):
    words = lambda t: [*(t or "").encode().lower().split(), b"<end>"]
    counts = Counter(w for i, t in data if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return {i: (len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))) for i, t in data}


def test_language_model_base_and_gain(spark, sf):
    out = queries.QUERIES["op7_recurrent_lm"](spark, sf).toPandas()
    data = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain_base(data, lambda i: zlib.crc32(str(i).encode()) % 7 == 2)
    assert len(out) == len(data)
    for r in out.itertuples():
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.base_score == pytest.approx(base)
    held, seen = out[out["held_out"]], out[~out["held_out"]]
    assert held["score"].sum() > 0.85 * held["base_score"].sum()  # both are negative
    assert seen["score"].sum() > 1.02 * seen["base_score"].sum()  # what was counted is known to the base at full weight


def test_model_is_a_distribution_and_carries_its_state():
    rng = np.random.default_rng(0)
    sizes = {0: 3, 1: 2}
    output = gru.Output(np.array([0, 0, 0, 1, 1, 2]), np.array([0, 1, 2, 0, 1, -1]), sizes)
    model = gru.fresh(8, output, np.array([5.0, 3.0, 2.0]), {0: np.ones(3), 1: np.ones(2)})
    model.recur = (rng.normal(size=model.recur.shape) * 0.2).astype(np.float32)  # a strong one would be chaotic
    as_input = np.arange(6)
    head = np.array([0, 3, 1, 4, 2] * 20, np.int32)
    whole = gru.score(model, output, as_input, 7, [head])[0]
    nexts = [gru.score(model, output, as_input, 7, [np.append(head, np.int32(w))])[0] - whole for w in range(6)]
    assert sum(math.exp(x) for x in nexts) == pytest.approx(1, abs=1e-4)
    for window in (1, 7, 1000):
        assert gru.score(model, output, as_input, 7, [head, head[:3]], window=window)[0] == pytest.approx(whole, rel=1e-5)


def test_gradients_against_differences():
    """One training step must lower the loss of a pattern that only the state can predict."""
    output = gru.Output(np.array([0, 1, 2]), np.array([-1, -1, -1]), {})
    docs = [np.array([0, 0, 1, 0, 0, 1, 0, 0, 1, 2], np.int32)] * 200
    model = gru.fresh(4, output, np.array([6.0, 3.0, 1.0]), {})
    start = gru.score(model, output, np.arange(3), 3, docs[:1])[0]
    gru.train(model, output, np.arange(3), 3, docs, epochs=30)
    assert gru.score(model, output, np.arange(3), 3, docs[:1])[0] > start + 4


def test_language_model_of_awkward_rows(spark):
    docs = language_model.split(clashing(documents(spark)))
    out = language_model.score(docs, language_model.fit(docs.filter(~F.col("held_out")))).collect()
    assert len(out) == len(rows()) and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in out)
    assert {r["n_tokens"] for r in out if r["doc_id"] in (3, 4, 5)} == {1}
    none = docs.filter("false")
    assert language_model.score(none, language_model.fit(none)).count() == 0
    assert all(r["n_known"] == 0 for r in language_model.score(docs, language_model.fit(none)).collect())


def test_weights_and_groups_come_from_all_documents(spark, monkeypatch):
    """Every third document is of a second kind, and all of these come after the first thousand in hash order."""
    rng = np.random.default_rng(4)
    names = lambda k: [f"{k}{a}{b}" for a in "abcdefgh" for b in "abcde"]
    order = [r["doc_id"] for r in spark.range(2100).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    kinds = {d: names("x") if at < 1400 else names("y") for at, d in enumerate(order)}

    def text(words):
        at, out = int(rng.integers(len(words))), []
        for _ in range(20):  # each word tells the next
            out.append(words[at])
            at = (at + 1) % len(words)
        return " ".join(out)

    docs = language_model.split(spark.createDataFrame([(d, text(w)) for d, w in kinds.items()], "doc_id long, text string"))
    monkeypatch.setattr(language_model, "WORKER_TOKENS", 12_000)
    monkeypatch.setattr(gru, "LANES", 8)
    lm = language_model.fit(docs)
    groups = [{int(lm.vocabulary.groups[lm.vocabulary.ids[w]]) for w in names(k)} for k in "xy"]
    assert groups[0].isdisjoint(groups[1])
    out = {r["doc_id"]: r["score"] - r["base_score"] for r in language_model.score(docs, lm).collect()}
    late = [v for d, v in out.items() if kinds[d][0][0] == "y"]
    assert len(late) == 700 and min(late) > 0
    first = gru.fresh(lm.vocabulary.start_id + 1, lm.vocabulary.output, lm.vocabulary.class_counts, lm.vocabulary.word_counts)
    used = lm.model.inputs != first.inputs
    assert all(used[lm.vocabulary.as_input[lm.vocabulary.ids[w]]].any() for k in "xy" for w in names(k))


def test_every_head_word_has_a_softmax_and_an_input():
    head = [(f"w{i}", 10_000 - i) for i in range(3_000)]
    by_group = np.zeros((3_000, language_model.GROUPS))
    by_group[np.arange(3_000), np.arange(3_000) % 3] = 1
    v = language_model.vocabulary(head, 5, by_group, 100)
    assert (v.output.place[:3_000] >= 0).all() and len(set(v.as_input.tolist())) == len(v.as_input)
    assert max(v.output.sizes.values()) <= 55 and min(v.output.sizes.values()) >= 50
    for c, n in v.output.sizes.items():
        members = np.flatnonzero(v.output.classes == c)
        assert len(members) == n and sorted(v.output.place[members]) == list(range(n)) and len(set(v.groups[members])) == 1
