"""Classifier, mixing, search, urls and pages against plain versions."""

from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from plumelake.llm import mixing, quality_classifier as qc, queries, templates, topk, url_filter


# --- quality classifier ---------------------------------------------------------

def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_tables_learn_an_interaction():
    """The label is an exclusive or of two features, which no sum of tables expresses."""
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = qc.fit(x[:3000], y[:3000])
    assert auc(model.score(x[3000:]), y[3000:]) > 0.98
    assert {0, 2} in [{f, g} for f, g, _ in model.pairs]
    again = qc.fit(x[:3000], y[:3000])
    assert np.array_equal(model.score(x), again.score(x))


def test_no_labels_or_one_kind():
    assert qc.fit(np.zeros((0, 16)), np.zeros(0)).score(np.zeros((2, 16))).tolist() == [0.5, 0.5]
    assert qc.fit(np.ones((5, 16)), np.ones(5)).score(np.ones((1, 16)))[0] > 0.99


def test_held_out_accuracy(spark):
    got = queries.op2_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").toPandas()
    assert auc(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.95
    assert (rows["predicted"] == rows["quality"]).mean() > 0.95


def test_classifier_on_odd_tables(spark, crowded, no_docs, corpus):
    labels = spark.createDataFrame([(n, n % 2) for n in range(20)] + [(None, 1), (3, None), (4, 7), (10 ** 9, 1)],
                                   "doc_id long, quality int")
    model = qc.train(crowded, labels)
    got = crowded.select(qc.score(F.col("text"), model).alias("s")).collect()
    assert len(got) == len(corpus) and all(0 <= r["s"] <= 1 for r in got)
    assert qc.train(no_docs, labels).score(np.zeros((1, 16)))[0] == 0.5
    assert no_docs.select(qc.score(F.col("text"), model)).count() == 0
    small = qc.train(crowded, labels, sample=5)
    assert small.intercept is not None


# --- mixing ---------------------------------------------------------------------

def mixed(docs):
    return mixing.mix(docs).toPandas()


def test_targets(docs, corpus):
    sizes = Counter()
    for r in corpus:
        sizes[r[3]] += len(brute.words(r[1]))
    light = docs.groupBy(F.col("source").alias("_source")).agg(
        F.sum(F.size(F.expr("filter(split(coalesce(text, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x != '')"))).alias("_source_size"))
    got = {r["_source"]: (r["_source_size"], r["_target"]) for r in mixing.source_targets(light).collect()}
    want = brute.source_targets(sizes)
    assert {s: v[0] for s, v in got.items()} == dict(sizes)
    assert {s: v[1] for s, v in got.items()} == pytest.approx(want)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1}, {"a": 5}, {"a": 0, "b": 7, None: 3},
                                   {f"s{n:02}": n * n for n in range(40)}])
def test_targets_with_stops(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "_source string, _source_size long")
    got = {r["_source"]: r["_target"] for r in mixing.source_targets(table).collect()}
    assert got == pytest.approx(brute.source_targets(sizes))


def test_taken_words_come_near_the_target(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit(None).cast("string")),
                                                  F.least(F.floor(F.sqrt(F.col("id") % 16)) + 1, F.lit(4)).cast("int")).alias("source"),
        (1 + F.pmod(F.xxhash64("id"), F.lit(300))).alias("size"))
    got = mixing.mix(rows, size=F.col("size")).toPandas()
    assert len(got) == 20_000 and set(got["copies"]) <= {0, 1, 2, 3}
    got["source"] = rows.select("source").toPandas()["source"].fillna("none")
    got["taken"] = got["size"] * got["copies"]
    per = got.groupby("target").agg(taken=("taken", "sum"))
    assert ((per["taken"] - per.index).abs() < 0.0005 * per.index + 1).all()
    again = mixing.mix(rows.repartition(7), size=F.col("size")).toPandas()
    assert dict(zip(got["doc_id"], got["copies"])) == dict(zip(again["doc_id"], again["copies"]))


def test_mixing_odd_tables(docs, crowded, no_docs, corpus):
    got = mixed(crowded)
    assert len(got) == len(corpus)
    wanted = got.dropna(subset=["doc_id"]).groupby("doc_id")["copies"].sum().to_dict()
    rows = mixing.mixed_documents(docs)
    assert rows.columns == docs.columns
    have = Counter(r["doc_id"] for r in rows.where("doc_id is not null").collect())
    assert dict(have) == {int(d): n for d, n in wanted.items() if n}
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


# --- top k ----------------------------------------------------------------------

VECTOR = "vec_id long, embedding array<float>, score string"


@pytest.mark.parametrize("k,block", [(5, 16), (3, 4096), (1, 7)])
def test_top_k(spark, k, block):
    rng = np.random.default_rng(k)
    rows = [(n, [float(np.float32(x)) for x in rng.normal(size=12)], "clash") for n in range(150)]
    rows += [(1000 + n, rows[3][1], "tie") for n in range(30)] + [(7, rows[9][1], "same id"), (10, rows[11][1], "same id")]
    rows += [(201, None, ""), (None, rows[0][1], ""), (202, [float("nan")] * 12, ""), (203, [None] + rows[0][1][1:], ""),
             (204, [float("inf")] * 12, ""), (210, rows[0][1][:5], ""), (211, rows[1][1][:5], ""), (220, [], "")]
    got = topk.top_k(spark.createDataFrame(rows, VECTOR).repartition(3), k, F.col("vec_id") % 10 == 0, block=block)
    have = sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())
    assert have == brute.top_k([r[:2] for r in rows], k, 10)


def test_top_k_exact_beyond_doubles_and_empty(spark):
    rows = [(n, [1e6 + (n % 3) / 256, 3.0 * n, 0.5], "") for n in range(40)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string"), 4, F.col("vec_id") % 10 == 0)
    have = sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())
    assert have == brute.top_k([r[:2] for r in rows], 4, 10) and have[0][3] > 2 ** 53
    none = spark.createDataFrame([], VECTOR)
    assert topk.top_k(none, 5, F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame([(1, [1.0], "")], VECTOR), 5, F.col("vec_id") == 1).count() == 0


# --- urls -----------------------------------------------------------------------

URLS = ["http://a.COM/", "https://www.Example.com/en/x?y#z", "example.com/en/", None, "", "://", "http://", "ftp://net/es/1",
        "http://x.net/es", "http://x.net/es/", "http://notexample.com/en/", "http://a.com?b/c", "http://a.com#/d://e",
        "http://É.com/ß/?q", "http://u:p@a.net:80/fr/é", "x" * 50_000 + "://h.org/" + "y" * 50_000, "HTTP://com/", "http://example.com/en"]


@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.fit_urls(url_filter.url_table(spark))


def test_hosts_paths_and_rules(spark, url_model):
    pages = spark.createDataFrame([(n, u, "x", "y") for n, u in enumerate(URLS + URLS)], "page_id long, url string, host string, verdict string")
    got = url_filter.judge_urls(pages, queries.URL_RULES, url_model).orderBy("page_id").collect()
    assert len(got) == 2 * len(URLS)
    for r, u in zip(got, URLS + URLS):
        host, path = brute.url_parts(u)
        rule, verdict = brute.url_rule(host, path, queries.URL_RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or verdict is None and r["verdict"] in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0), [], url_model).count() == 0


def test_regression_judges_by_n_grams(spark, url_model):
    """The score is that of a plain sum of weights, and unseen addresses are told apart."""
    import math
    urls = ["http://best-casino-slots.example.org/play", "http://cheap-pills-online.example.com/buy",
            "http://city-library.example.org/en/opening", "https://science-museum.example.net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge_urls(pages, [], url_model).orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["block", "block", "allow", "allow"]
    hashing, regression = url_model.stages
    weights = regression.coefficients.toArray()
    for r in got:
        host, path = f"^{r['host']}$", r["path"]
        grams = {m + s[i:i + n] for m, s in (("h", host), ("p", path)) for n in url_filter.SIZES
                 for i in range(len(s) - n + 1)}
        total = regression.intercept + sum(weights[i] for i in {hashing.indexOf(g) for g in grams})
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-6)


# --- pages ----------------------------------------------------------------------

def test_pages_of_the_sample(spark):
    import re
    from html import unescape
    sf = "/root/testdata/sf0.01"
    got = {r["page_id"]: r for r in queries.op7_main_text(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S).group(1)
        blocks = [re.sub(r"\s+", " ", unescape(re.sub("<[^>]*>", "", b))).strip()
                  for b in re.split("</?(?:p|h1|br)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))


MARKUP = """<html><head><title>T</title><script>if (a < b) "</p>"</script></head><body class="dark">
<header><h2>Site</h2></header><div id="cookie-bar" class="notice">We use</div>
<div class="sidebar"><p>Side</p></div><main><header><h1>Head &amp; line</h1></header>
<p>One <b>two
 three</b><p>Four&nbsp;five<br>six<ul><li>a<li>b</ul><aside>aside</aside><form><p>f</p></form>
<table><tr><td>x<td>y</table><section class='comments'><p>me too</p></section></main>
<p>outside</p><footer>foot</footer>"""


def test_roles_blocks_and_entities():
    assert templates._extract(MARKUP, set(), set(), set()).split("\n") == [
        "Head & line", "One two three", "Four five six", "a", "b", "x", "y"]


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("plain &lt;text", "plain <text"), ("<p>a<p>b</div></p>c", "a\nb\nc"), ("<", "<"), ("a < b", "a < b"),
    ("<article><p>x</article><p>y", "x"), ("<!-- <p>no</p> --><p>yes", "yes"), ("<script>never", ""), ("<p title='>'>q", "q"),
    ("<div>" * 300 + "deep", "deep")])
def test_tolerant_parser(html, want):
    assert templates._extract(html, set(), set(), set()) == want


def test_constant_text_is_template(spark):
    """A sentence on every page of a host is no slot; one on some pages is."""
    rows = [(n, f"http://h.org/{n}", f"<div><p>Always the same here.</p><p>Own text {n}.</p>"
             + ("<p>Seen on some.</p>" if n % 3 == 0 else "") + "</div>") for n in range(30)]
    rows += [(100, "http://small.org/", "<div><p>Always the same here.</p></div>"), (101, None, "<p>x</p>"),
             (101, None, "<p>x</p>"), (None, "http://h.org/z", None)]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, host string")
    got = sorted(((r["page_id"], r["text"]) for r in templates.main_text(pages).collect()), key=repr)
    assert (0, "Own text 0.\nSeen on some.") in got and (1, "Own text 1.") in got
    assert (100, "Always the same here.") in got or (100, "") in got
    assert got.count((101, "x")) == 2 and (None, "") in got and len(got) == len(rows)
    assert templates.main_text(pages.limit(0)).count() == 0


def test_line_that_all_articles_share_stays(spark):
    pages = spark.createDataFrame([(n, f"http://h.org/{n}", f"<nav>menu</nav><article><p>Shared line.</p><p>{n}</p></article>")
                                   for n in range(20)], "page_id long, url string, html string")
    assert {r["text"] for r in templates.main_text(pages).collect()} == {f"Shared line.\n{n}" for n in range(20)}


def test_equal_vectors_make_a_class(spark):
    rows = spark.createDataFrame([(n, "h", f"<nav><a>x</a></nav>{'<p>t' * (n % 4)}") for n in range(12)],
                                 "page long, host string, html string")
    tokens = rows.mapInPandas(templates._count_tokens, templates._TOKENS)
    vector = {r["path"]: r["vector"] for r in templates.token_classes(tokens).where("text = ''").collect()}
    assert vector["nav"] == vector["nav/#text"] != vector["p"] == vector["p/#text"]


def texts_of(spark, *rows):
    pages = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "page_id long, url string, html string")
    return [r["text"] for r in templates.main_text(pages).orderBy("page_id").collect()]


def test_pages_without_article_on_a_mixed_host_keep_their_text(spark):
    rows = [("http://m.org/", f"<body><article><p>A {n}</p></article></body>" if n % 5 else
             f"<body><div><p>Plain {n}</p></div></body>") for n in range(40)]
    rows += [("http://one.org/", "<body><div><p>Single</p></div></body>")]
    assert texts_of(spark, *rows) == [f"A {n}" if n % 5 else f"Plain {n}" for n in range(40)] + ["Single"]


def test_small_host_has_its_own_template(spark):
    rows = [(f"http://{host}.org/", f"<div><p>Banner of {host}</p><p>Own {n}</p></div>")
            for host in ("two", "three") for n in range(2 if host == "two" else 3)]
    rows += [("http://one.org/", "<div><p>Banner of one</p></div>")]
    assert texts_of(spark, *rows) == ["Own 0", "Own 1", "Own 0", "Own 1", "Own 2", "Banner of one"]


def test_repeated_rows_are_no_constant_text(spark):
    rows = [(n // 2, "http://h.org/", f"<div><p>Own {n // 2}</p></div>") for n in range(16)]
    rows += [(None, "http://h.org/", f"<div><p>Nameless {n}</p></div>") for n in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter(r["text"] for r in templates.main_text(pages).collect())
    assert got == Counter({f"Own {n}": 2 for n in range(8)} | {f"Nameless {n}": 1 for n in range(3)})


def test_classes_in_fixed_order_are_template(spark):
    """The menu of a section, in an unnamed container, is a class in one arrangement;
    texts with equal vectors in changing order are none."""
    menu = "<div class=x1><i>North</i><p>East</p><p>South</p></div>"
    lines = ["First line", "Second line", "Third line"]
    rows = [("http://h.org/", "<p>lead</p>" * (n % 3) + (menu if n % 2 else "<div class=x2>" + "".join(
        f"<p>{lines[(n // 2 * k + k) % 3]}</p><p>{n} {k}</p>" for k in range(3)) + "</div>") + f"<p>Own {n}</p>")
        for n in range(40)]
    got = texts_of(spark, *rows)
    assert not any("North" in t or "East" in t or "South" in t for t in got)
    assert all(f"Own {n}" in t for n, t in enumerate(got))
    assert "First line" in got[0]


def test_recurring_slot_is_template_and_names_give_way(spark):
    rows = [("http://ads.org/", f"<div class=q7><p>Buy {n % 4}</p></div><div><p>Own {n}</p></div>") for n in range(40)]
    rows += [("http://w.org/", f"<nav>menu</nav><div class=widget><p>Story {n}</p></div>") for n in range(40)]
    rows += [("http://mix.org/", "<div>" + "".join(f"<p>Line {n % 4} {k}</p>" for k in range(20)) + f"<p>Own {n}</p></div>")
             for n in range(40)]
    assert texts_of(spark, *rows) == [f"Own {n}" for n in range(40)] + [f"Story {n}" for n in range(40)] + [
        f"Own {n}" for n in range(40)]


@pytest.mark.parametrize("piece", ["<a ", "<a <b ", "</", "<a '", '<p "', "<!", "<a href=x ", "&lt;<", "<a \"x\" 'y' "])
@pytest.mark.parametrize("tail", ["", '"', "'>", '" >', ">"])
def test_pages_of_unclosed_tags_are_read_in_one_pass(piece, tail):
    import time
    start = time.process_time()
    list(templates.parse(piece * 40_000 + tail))
    assert time.process_time() - start < 5
    short = piece * 3 + tail + "<p>text</p>"
    assert "".join(t for kind, _, t in templates.parse(short) if kind == "text").endswith("text") or "<" in short[:-11]


def test_character_data_without_an_end_is_whole():
    def text(html):
        return [t for kind, _, t in templates.parse(html) if kind == "text"]
    assert text("<p><![CDATA[abcdef") == ["abcdef"] and text("<p><![CDATA[abc]]>d</p>") == ["abcd"]


def test_roles_of_a_text_are_told_apart_by_its_place(spark):
    """One text is a heading of the site on every page, and own text of four pages."""
    rows = [("http://r.org/", f"<div><h1>Site</h1><p>Topics</p><hr><p>Own {n}</p>" + "<p>Topics</p>" * (n < 4) + "</div>")
            for n in range(40)]
    assert texts_of(spark, *rows) == [f"Own {n}" + "\nTopics" * (n < 4) for n in range(40)]


def test_members_of_a_class_need_order_not_distance(spark):
    """The menu of a section, with own lines in changing number between its entries."""
    def between(n, k):
        return "".join(f"<p>Own {n} {k} {x}</p>" for x in range(n % (k + 2)))
    rows = [("http://o.org/", f"<div>{between(n, 3)}" + (
        f"<b>North</b>{between(n, 0)}<p>East</p>{between(n, 1)}<p>South</p>{between(n, 2)}" if n % 2 else "") + "<p>end</p></div>")
        for n in range(40)]
    for text in texts_of(spark, *rows):
        assert "East" not in text and "South" not in text


def test_slots_are_gaps_of_the_template(spark):
    """Rotating adverts and own text have the same path, on either side of a line."""
    rows = [("http://g.org/", f"<div><h1>Site</h1><p>Buy {n % 4}</p><hr>" + "".join(
        f"<p>Own {n} {k}</p>" for k in range(3)) + "</div>") for n in range(40)]
    assert texts_of(spark, *rows) == ["\n".join(f"Own {n} {k}" for k in range(3)) for n in range(40)]


def test_classes_are_valid_and_nested(spark):
    """Tags are members; the class of an item lies in a gap of the class of the page, and a
    line in it, split off in a later round, too."""
    html = [(f"h{n % 2}", "<body><h1>T</h1><ul>" + f"<li><h2>x {n}</h2><p>Same</p><p>y {n}</p></li>" * (1 + n // 2 % 3)
             + "</ul><p>Same</p></body>") for n in range(24)]
    got = templates.deduce(spark.createDataFrame(html, "host string, html string")).collect()
    assert {r["host"] for r in got} == {"h0", "h1"}
    for r in got:
        root, item = sorted(r["nested"], key=lambda c: c["parent"] is not None)
        assert root["parent"] is None and item["parent"] == root["cls"]
        size = {c: n for c, n, level in zip(r["ids"], r["lengths"], r["rounds"]) if level == max(r["rounds"])}
        # body, h1, T, /h1, ul, /ul, p, Same, /p, /body; li, h2, /h2, p, Same, /p, p, /p, /li
        assert (size[root["cls"]], size[item["cls"]], len(size)) == (10, 9, 2)
        assert max(r["rounds"]) >= 1


@pytest.mark.parametrize("roles,bad", [
    ([1, 2, 3, 11, 12, 13], set()), ([1, 11, 12, 13, 11, 12, 13, 2, 3], set()), ([1, 3, 2], {(5, 1), (5, 2)}),
    ([1, 2, 3, 1, 3, 2], {(5, 1), (5, 2)}), ([1, 11, 2, 12, 3, 13], {(5, -1)}), ([1, 11, 12, 2, 3, 13], {(5, -1)}),
    ([11, 13, 12, 1, 2, 3], {(6, 1), (6, 2)}), ([9, 1, 9, 2, 9, 3, 9], set())])
def test_validity_of_classes_on_a_page(roles, bad):
    members = {1: (5, 0, 3), 2: (5, 1, 3), 3: (5, 2, 3), 11: (6, 0, 3), 12: (6, 1, 3), 13: (6, 2, 3)}
    assert templates._invalid(roles, members) == bad
    if not bad:
        # Gaps: nothing is left open at the end.
        assert templates._gaps([*roles, 99], members)[-1] is None


def test_parts_of_a_hot_host_and_copies_count_once(spark, monkeypatch):
    monkeypatch.setattr(templates, "CHUNK", 7)
    rows = [("http://h.org/", f"<div><p>Always.</p><p>Own {n % 30}</p></div>") for n in range(60)]
    assert texts_of(spark, *rows) == [f"Own {n % 30}" for n in range(60)]
