import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernel.llm import gru, html_extraction, language_id, lm_scoring, warc
from quernel.llm.common import shared_dir, table
from quernel.llm.html_pages import labelled_pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body>
<header><a href="/">Site name</a></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice">We use cookies on this page.</div><!-- <p>hidden</p> -->
<article><h1>A title &amp; more</h1><p>First   paragraph with <b>bold</b> text,<br>a break and a <a href="/x">link</a>.
<p>Second one isn&#39;t closed. It has two sentences.<ul><li>one item here</li><li>another item there</li></ul>
<table><tr><td>cell one<td>cell two</table><blockquote>Quoted words of somebody.</blockquote></article>
<aside><h3>Related</h3><ul><li><a href="/r">Other story</a></ul></aside>
<form><label>Mail <input></label><button>Send</button><textarea>typed</textarea></form>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I read this and liked it a lot. Thanks!</p></div></section>
<footer>&copy; 2020 Somebody. All rights reserved.</footer></body></html>"""

TEXT = "A title & more\nFirst paragraph with bold text, a break and a link.\nSecond one isn't closed. It has two sentences.\none item here\nanother item there\ncell one\ncell two\nQuoted words of somebody."


def test_page_text():
    assert html_extraction.default_model().extract(PAGE) == TEXT


@pytest.mark.parametrize(
    "html,want",
    [
        ('<body><div id="menu"><a href=1>x</a> | <a href=2>y</a></div><div class="content"><h2>Head line</h2><p>Some words that make a sentence here.</p><div class="share">Share this</div></div><div class="sidebar"><p>Popular posts this week.</p></div></body>', "Head line\nSome words that make a sentence here."),
        ('<body><h1>Plain page</h1><p>Nothing else than text is here, and it is long enough.</p><p>Another paragraph of words.</p></body>', "Plain page\nNothing else than text is here, and it is long enough.\nAnother paragraph of words."),
        ('<main><section class="post"><p>Body text of the post goes here.</p></section><ol class="commentlist"><li class="comment"><p>A reader says this about it.</p></li></ol></main>', "Body text of the post goes here."),
        ('<div class="wrapper"><div class="advert"><p>Buy now at a low price today.</p></div><article><p>The real text of this page.</p><aside class="promo">Subscribe today</aside><p>It goes on here.</p></article></div>', "The real text of this page.\nIt goes on here."),
        ('<nav><a href="1">x</a></nav><h1>T</h1><p>The words of this page go on for a while, and make sense.</p><p>They do, and they go on for longer than that.</p><ul id="comments"><li>I liked this text a lot. Thanks!</li></ul><footer>f</footer>', "T\nThe words of this page go on for a while, and make sense.\nThey do, and they go on for longer than that."),
        ('<main><article><header><h1>Title here</h1></header><section><h2>A</h2><p>The words of this page go on for a while.</p></section><section><h2>B</h2><p>Short.</p></section><p hidden>Not shown to anybody.</p></article></main>', "Title here\nA\nThe words of this page go on for a while.\nB\nShort."),
        ("", ""), ("<p>", ""), ("<script>only</script>", ""), ("<!-- open", ""), ('<a href="', ""), ("</p></div>", ""),
    ],
)
def test_other_designs(html, want):
    assert html_extraction.default_model().extract(html) == want


BODY = "<article><h1>A real title</h1><p>These are the words of the article, and there are enough.</p>{}<p>They go on in a second paragraph here.</p></article>"
SAID = "A real title\nThese are the words of the article, and there are enough.\nThey go on in a second paragraph here."


@pytest.mark.parametrize(
    "html",
    [
        "<html><head><title>T</title><meta charset=utf-8><body>" + BODY.format("") + "</body></html>",
        "<html><head><title>T</title>" + BODY.format(""),
        "<head><script>var x = '</head>';</script><noscript><style>p{}</style>Turn it on</noscript>" + BODY.format(""),
        "<body>" + BODY.format("<button>Press"),
        "<body>" + BODY.format("<button><span>One</span></button><button>Two"),
        "<body>" + BODY.format("<button><div>Deep</div> press</button>"),
        "<body>" + BODY.format("<noscript>Please turn on scripts"),
        "<body>" + BODY.format("<svg><g><svg><text>inner</text></svg><text>outer</text></g></svg>"),
        "<body>" + BODY.format("<svg><text>never closed"),
        "<body>" + BODY.format("<select><option>a<option>b</select>"),
        "<body>" + BODY.format("<select><option>a<option>b"),
        "<body>" + BODY.format("<object><p>No plugin.</p></object><video><p>No video.</p></video><canvas>No canvas</canvas>"),
        "<body>" + BODY.format("<template><p>Not shown</p><template>x</template></template><textarea><p>typed</textarea><iframe><p>x</iframe>"),
        "<body>" + BODY.format('<script>if (a < b) { document.write("<p>no</p>") }</script><style>x > y {}</style>'),
        "<body>" + BODY.format("") + "<script>never closed <p>no text",
    ],
)
def test_silent_elements(html):
    assert html_extraction.default_model().extract(html) == SAID


#: Pages written by hand, not by the generator of the training pages: (html, main text).
HAND_PAGES = [
    (
        '<!doctype html><html lang=en><head><meta charset=utf-8><title>Tides - Harbour Weekly</title><link rel=stylesheet href=a.css><body class="single"><div id="page"><div class="topbar"><a href="/login">Log in</a> <a href="/subscribe">Subscribe</a></div>'
        '<header class="site-header"><a class="logo" href="/">Harbour Weekly</a><nav class="main-nav"><a href="/n">News</a> <a href="/s">Sport</a></nav></header><div class="row"><div class="col-8"><h1 class="entry-title">Why the tides were late</h1>'
        '<div class="entry-content"><p>The harbour master says the tide tables were printed a day late this year.</p><p>Nobody noticed until the ferry ran aground &mdash; twice &mdash; in one week.</p><h2>What happens next</h2><ul><li>New tables will be printed.</li><li>The ferry has been moved.</li></ul>'
        '<div class="ad-slot">Advertisement</div><p>The council meets again on Friday to discuss the matter.</p></div><div class="share-buttons"><a href="#">Share</a> <a href="#">Tweet</a></div></div>'
        '<div class="sidebar col-4"><h3>Most read</h3><ul><li><a href="/1">Cat found in chimney</a></li><li><a href="/2">Bridge painted again</a></li></ul></div></div>'
        '<div id="comments"><h3>2 comments</h3><div class="comment"><p>I was on that ferry and it was no fun.</p></div></div><footer class="site-footer"><p>Copyright 2021 Harbour Weekly. <a href="/privacy">Privacy</a></p></footer></div></body></html>',
        "Why the tides were late\nThe harbour master says the tide tables were printed a day late this year.\nNobody noticed until the ferry ran aground — twice — in one week.\nWhat happens next\nNew tables will be printed.\nThe ferry has been moved.\nThe council meets again on Friday to discuss the matter.",
    ),
    (
        "<html><head><title>notes</title></head><body><nav><ul><li><a href=/>index</a><li><a href=/about>about</a></ul></nav><main><h1>Building a small boat</h1><p>It took three winters to build the boat in the shed behind the house.<p>The plans came from a library book that was never returned."
        "<pre>length 4.2 m\nbeam   1.6 m</pre><blockquote><p>A boat is a hole in the water, my uncle said.</p></blockquote><table><tr><th>part<th>wood</tr><tr><td>keel<td>oak</tr></table></main><aside><p>About the author: she lives by the sea.</p></aside><footer><small>&copy; 2019</small></footer></body></html>",
        "Building a small boat\nIt took three winters to build the boat in the shed behind the house.\nThe plans came from a library book that was never returned.\nlength 4.2 m beam 1.6 m\nA boat is a hole in the water, my uncle said.\npart\nwood\nkeel\noak",
    ),
    (
        '<body><div class="cookie-banner" role="dialog"><p>We value your privacy. Accept all cookies?</p><button>Accept</button></div><div id="nav"><a href=a>Start</a> | <a href=b>Archive</a></div><article class="post"><h2>Second hand bicycles</h2><p class="lead">Buying a used bicycle is easy if you look at three things first.</p>'
        '<p>Look at the frame, the wheels and the chain, in this order.</p><form action="/newsletter"><label>Get our newsletter</label><input name=m><button>Go</button></form><p>If all three are fine, pay and ride home.</p></article><section class="related-posts"><h3>You may also like</h3><ul><li><a href=c>New tyres</a></li></ul></section></body>',
        "Second hand bicycles\nBuying a used bicycle is easy if you look at three things first.\nLook at the frame, the wheels and the chain, in this order.\nIf all three are fine, pay and ride home.",
    ),
]


@pytest.mark.parametrize("html,want", HAND_PAGES)
def test_hand_written_pages(html, want):
    assert html_extraction.default_model().extract(html) == want


def test_messages_give_exact_marginals():
    model = html_extraction.default_model()
    page = html_extraction.Page('<body><nav><a href=1>x</a></nav><div><p>Words here.</p><div class="ad">y</div></div><footer>z</footer></body>')
    n = len(page.parent)
    evidence = [model.evidence(f) for f in page.features()]
    joint = np.zeros((n, 2))
    for bits in range(1 << n):
        x = [bits >> i & 1 for i in range(n)]
        p = model.root[x[0]] * evidence[0][x[0]]
        for i in range(1, n):
            p *= model.pair[page.bond(i)][x[page.parent[i]]][x[i]] * evidence[i][x[i]]
        for i in range(n):
            joint[i, x[i]] += p
    assert np.allclose(joint[:, 1] / joint.sum(1), model.marginals(page))


def test_held_out_pages():
    model, same, all_ = html_extraction.default_model(), 0, 0
    for html in labelled_pages(120, seed=321):
        page = html_extraction.Page(html, labels=True)
        want = page.text([x == 1 for x in page.label]).split("\n")
        got = model.extract(re.sub(r' data-label="\d"', "", html)).split("\n")
        same += 2 * sum((collections.Counter(want) & collections.Counter(got)).values())
        all_ += len(want) + len(got)
    assert same / all_ > 0.97


def test_main_texts(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>text</p>" * 3000), (4, "x", "<div>" * 3000 + "deep words")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("x"))
    got = html_extraction.main_texts(df).collect()
    assert len(got) == 6 and sum(x["text"] == TEXT for x in got) == 2 and all(x["n_chars"] == len(x["text"]) for x in got)
    assert {x["page_id"]: x["text"] for x in got}[2] == "" and html_extraction.main_texts(df.limit(0)).count() == 0


def pages_frame(spark):
    long, longer = "<p>é</p>" * 200, "<p>x</p>" * 400
    rows = [(1, "http://a/é b\n", long), (2, "u2", long), (7, "u7", long), (3, None, "short"), (4, "u4", "short"), (5, "u5", None), (6, "u6", ""), (None, "un", long), (8, "u8", longer), (7, "u7", long), (9, "u9", "x" * 400_000)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("keeper", F.lit(1))


@pytest.mark.parametrize("most", [warc.BROADCAST_ROWS, 0])
def test_warc_round_trip(spark, most):
    rows, df = pages_frame(spark)
    folder = f"{shared_dir(spark)}/warc-test-{most}"
    index = warc.write_archives(df, folder, frame_bytes=4000, bundle_bytes=1500, most_broadcast=most)
    entries = index.collect()
    assert len(entries) == len(rows) and len({e["record_id"] for e in entries}) == len({r[0] for r in rows}) and len({e["bundle"] for e in entries}) > 1
    want = sorted(
        ((p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), *(("revisit", 7) if h == rows[0][2] and p != 7 else ("response", None))) for p, _, h in rows), key=str
    )
    got = warc.read_archives(spark, folder, index.select("bundle").distinct())
    assert sorted(((x["page_id"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"]) for x in got.collect()), key=str) == want
    place = {(x["bundle"], x["frame"], x["frame_offset"]): x["page_id"] for x in got.collect()}
    html = {r[0]: r[2] or "" for r in rows}
    for e in entries:
        head, payload = warc.read_record(folder, e)
        assert head["warc-record-id"] == f"<{e['record_id']}>" and place[e["bundle"], e["frame"], e["frame_offset"]] == e["page_id"]
        assert payload.decode() == ("" if head["warc-type"] == "revisit" else html[e["page_id"]])


def test_warc_bundle_is_plain_zstd(spark):
    import zstandard

    rows, df = pages_frame(spark)
    folder = f"{shared_dir(spark)}/warc-plain"
    names = {r["bundle"] for r in warc.write_archives(df, folder).collect()}
    files, root = warc.open_folder(folder)
    found = 0
    for n in names:
        raw = files.open_input_file(f"{root}/{n}").read()
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        found += sum(1 for _ in warc.parse_records(whole))
    assert found == len(rows)


def test_warc_empty(spark):
    _, df = pages_frame(spark)
    folder = f"{shared_dir(spark)}/warc-empty"
    assert warc.read_archives(spark, folder, warc.write_archives(df.limit(0), folder).select("bundle").distinct()).count() == 0


def test_stashes_can_be_released(spark):
    from pathlib import Path

    from quernel.llm.common import drop_stash, release_stashes, stash

    a, b = stash(spark.range(5), "a"), stash(spark.range(6), "b")
    place = Path(a.inputFiles()[0].removeprefix("file://")).parent
    assert place.exists() and a.count() == 5
    drop_stash(a)
    drop_stash(spark.range(3))
    assert not place.exists() and b.count() == 6
    release_stashes(spark)
    assert not place.parent.exists()


def corpus(spark, n=160):
    r = random.Random(9)
    stock = {"en": "the and that with from this have which there would".split(), "de": "der und nicht mit von eine auch werden über können".split(), "fr": "les des une dans pour avec été sur être même".split()}
    rows = []
    for i in range(n):
        lang = r.choice(sorted(stock))
        rows.append((i, " ".join(r.choice(stock[lang]) + (r.choice([".", ",", ""])) for _ in range(r.randint(5, 120))), lang))
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "123 456 !!", "de"), (1003, "the and that", None), (None, "der und nicht mit", "de"), (1004, "les des une " * 120_000, "fr"), (5, "the and that with", "en"), (1005, "日本語", None)]
    return rows + odd, spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).withColumn("source", F.lit("s"))


def test_language_predictions(spark):
    rows, df = corpus(spark)
    trees = language_id.learn(df)
    got = language_id.predict(df, trees).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) and 0 <= x["score"] <= 1
    by = {x["doc_id"]: x for x in got}
    truth = {i: lang for i, t, lang in rows if i is not None and i < 1000 and i != 5}
    assert sum(by[i]["lang_pred"] == lang for i, lang in truth.items()) / len(truth) > 0.98
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None, 1004)] == ["und", "und", "und", "en", "de", "fr"] and by[1005]["lang_pred"] in ("de", "en", "fr")
    shuffled = df.withColumn("lang", F.lit("fr")).withColumn("source", F.lit("z"))
    assert sorted(language_id.predict(shuffled, trees).collect(), key=str) == sorted(got, key=str)
    assert language_id.learn(df.limit(0)) is None and language_id.predict(df, None).where("lang_pred <> 'und'").count() == 0 and language_id.predict(df.limit(0), trees).count() == 0


def test_code_lengths_equal_a_plain_model():
    texts = {"a": b"abracadabra abracadabra", "b": b"banana bandana ananas"}
    grams = {k: collections.Counter(t[i : i + w] for w in range(1, 5) for i in range(len(t) - w + 1)) for k, t in texts.items()}
    trees = language_id.ContextTrees(grams)
    symbols = sorted({s[-1] for g in grams.values() for s in g})

    def probability(g, context, b):
        while True:
            seen = {s[-1]: c for s, c in g.items() if s[:-1] == context}
            if seen:
                break
            context = context[1:]
        total, kinds = sum(seen.values()), len(seen)
        below = lambda y: probability(g, context[1:], y) if context else 1 / 256
        rest = sum(below(y) for y in symbols if y not in seen) + (below(-1) * (256 - len(symbols)) if True else 0)
        if b in seen:
            return seen[b] / total * (1 - kinds / (total + kinds))
        return kinds / (total + kinds) * below(b) / rest

    for text in (b"abra", b"banana zz", b"x"):
        got = trees.code_lengths(np.frombuffer(text, np.uint8), np.array([0]))[0]
        for k, bits in zip(trees.languages, got, strict=True):
            want = 0.0
            for i, b in enumerate(text):
                context = text[max(0, i - 3) : i]
                known = {s[:-1] for g in grams.values() for s in g}
                while context not in known:
                    context = context[1:]
                want -= math.log2(probability(grams[k], context, b if b in symbols else -1))
            assert bits == pytest.approx(want, rel=1e-4)
    both = trees.code_lengths(np.frombuffer(b"abrabanana", np.uint8), np.array([0, 4, 4]))
    assert np.allclose(both[0], trees.code_lengths(np.frombuffer(b"abra", np.uint8), np.array([0]))[0]) and not both[1].any()


def test_every_language_is_learned(spark):
    """More languages than any table of a fixed size would hold."""
    texts = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}" * 30 + " x", f"l{i:03d}") for i in range(300)]
    df = spark.createDataFrame([(4 * i + k, t, lang) for i, t, lang in texts for k in range(4)], "doc_id long, text string, lang string")
    trees = language_id.learn(df)
    assert len(trees.languages) == 300
    got = language_id.predict(df, trees).join(df, "doc_id").where("lang = lang_pred").count()
    assert got >= 0.95 * 1200


def test_least_counts(spark):
    rows = [("a", b"xy", 5), ("a", b"xz", 5), ("a", b"yz", 9), ("a", b"q", 50), ("b", b"pq", 1), ("c", b"s", 1)]
    got = lambda k: {r["lang"]: r["least"] for r in language_id.least_counts(spark.createDataFrame(rows, "lang string, gram binary, n long"), k).collect()}
    assert got(1) == {"a": 9, "b": 1, "c": 0} and got(2) == {"a": 9, "b": 1, "c": 0} and got(3) == {"a": 5, "b": 1, "c": 0}


def test_gradients():
    r = np.random.RandomState(1)
    p = {k: v.astype(np.float64) for k, v in gru.new_params(40, np.ones(gru.LEAVES)).items()}
    ids, leaves, h = r.randint(0, 40, (4, 3)), r.randint(0, gru.LEAVES, (4, 3)), r.standard_normal((3, gru.HIDDEN)) * 0.1
    g, _, _ = gru._gradients(p, ids, leaves, h)
    for k in p:
        i = (int(ids[0, 0]), 2) if k == "E" else (int(leaves[0, 0]) // gru.MEMBERS, 3, 1) if k == "Wm" else tuple(r.randint(0, s) for s in p[k].shape)
        up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
        up[k][i] += 1e-3
        down[k][i] -= 1e-3
        assert g[k][i] == pytest.approx((gru._gradients(up, ids, leaves, h)[2] - gru._gradients(down, ids, leaves, h)[2]) / 2e-3, rel=0.02, abs=2e-5)


def test_gradients_with_ends_and_beginnings():
    """Places without a token count for nothing, and nothing passes from one text to the next."""
    r = np.random.RandomState(3)
    p = {k: v.astype(np.float64) for k, v in gru.new_params(40, np.ones(gru.LEAVES)).items()}
    ids, leaves, h = r.randint(0, 40, (6, 2)), r.randint(0, gru.LEAVES, (6, 2)), r.standard_normal((2, gru.HIDDEN)) * 0.1
    fresh, valid = np.zeros((6, 2), bool), np.ones((6, 2), bool)
    fresh[3, 0] = fresh[0, 1] = True
    valid[4:, 1] = False
    g, _, loss = gru._gradients(p, ids, leaves, h, fresh, valid)
    for k in p:
        i = (int(ids[1, 0]), 2) if k == "E" else (int(leaves[0, 0]) // gru.MEMBERS, 3, 1) if k == "Wm" else tuple(r.randint(0, s) for s in p[k].shape)
        up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
        up[k][i] += 1e-3
        down[k][i] -= 1e-3
        assert g[k][i] == pytest.approx((gru._gradients(up, ids, leaves, h, fresh, valid)[2] - gru._gradients(down, ids, leaves, h, fresh, valid)[2]) / 2e-3, rel=0.02, abs=2e-5)
    parts = [(slice(0, 3), 0, h[:1]), (slice(3, 6), 0, 0 * h[:1]), (slice(0, 4), 1, 0 * h[:1])]
    alone = [gru._gradients(p, ids[s, j : j + 1], leaves[s, j : j + 1], state)[2] * (s.stop - s.start) for s, j, state in parts]
    assert loss * 10 == pytest.approx(sum(alone))


def test_sums_and_errors_equal_plain_ones():
    r = np.random.RandomState(12)
    for n, kinds in ((0, 5), (1, 5), (900, 40), (3000, 2305)):
        rows, values = np.minimum(r.zipf(1.4, n), kinds) - 1, r.standard_normal((n, 7))
        want = np.zeros((kinds, 7))
        np.add.at(want, rows, values)
        assert np.allclose(gru._summed_rows(rows.astype(np.int32), values, kinds), want)
    logits, at = r.standard_normal((16, 50)) * 30, r.randint(0, 16, 50)
    logs = logits - logits.max(0) - np.log(np.exp(logits - logits.max(0)).sum(0))
    d, total = gru._softmax_error(logits.copy(), at)
    assert total == pytest.approx(logs[at, np.arange(50)].sum())
    assert np.allclose(d, np.exp(logs) - (np.arange(16)[:, None] == at))


def test_large_weights_are_made_safe():
    p = gru.new_params(10, np.ones(gru.LEAVES))
    same = gru.safe(p)
    assert all(np.allclose(same[k], p[k]) for k in p)
    p["Wm"] = p["Wm"] * 1e4
    big = gru.safe(p)
    states, leaves = np.ones((gru.LEAVES, gru.HIDDEN), np.float32), np.arange(gru.LEAVES)
    got = gru.leaf_log_probs(big, states, leaves)
    assert np.isfinite(got).all() and np.exp(got).sum() == pytest.approx(1, abs=1e-4)


def test_scorer_carries_the_state():
    r = np.random.RandomState(2)
    p = gru.new_params(60, np.ones(gru.LEAVES))
    docs = [(r.randint(0, 60, n), r.randint(0, gru.LEAVES, n)) for n in (1, 33, 200, 64, 5, 700, 2)]
    together = gru.Scorer(p).score(docs)
    for (ids, leaves), total in zip(docs, together, strict=True):
        h, want = np.zeros((1, gru.HIDDEN), np.float32), 0.0
        for i, leaf in zip(ids, leaves, strict=True):
            x = p["E"][i] @ p["W"] + p["b"]
            hu = (h @ p["U"])[0]
            z, q = (1 / (1 + np.exp(-(x[k : k + gru.HIDDEN] + hu[k : k + gru.HIDDEN]))) for k in (0, gru.HIDDEN))
            c = np.tanh(x[2 * gru.HIDDEN :] + q * hu[2 * gru.HIDDEN :])
            h = (c + z * (h[0] - c))[None]
            want += gru.leaf_log_probs(p, h.astype(np.float32), np.array([leaf]))[0]
        assert total == pytest.approx(want, rel=1e-3)


def test_base_scores_equal_brute_force(spark):
    rows, df = corpus(spark, 120)
    got = lm_scoring.lm_scores(df.withColumn("word", F.lit(1)).withColumn("n_tokens", F.lit("x"))).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda t: (t or "").encode().lower().split()
    training = [tokens(t) for i, t, _ in rows if not held(i)]
    c = collections.Counter(w for t in training for w in t)
    n, v = sum(c.values()) + len(training), len(c) + 1
    want = []
    for i, t, _ in rows:
        w = tokens(t)
        log = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
        want.append((i or -1, held(i), len(w) + 1, sum(x in c for x in w) + 1, n, round(sum(log(c[x]) for x in w) + log(len(training)), 4)))
    assert sorted((x["doc_id"] or -1, x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"], round(x["base_score"], 4)) for x in got) == sorted(want)
    out = [x for x in got if x["held_out"]]
    assert sum(x["score"] for x in out) > sum(x["base_score"] for x in out)
    assert lm_scoring.lm_scores(df.limit(0)).count() == 0
    alone = lm_scoring.lm_scores(df.where("doc_id = 1000")).first()
    assert alone["n_tokens"] == 1 and math.isfinite(alone["score"])


def test_model_probabilities_add_up(spark):
    rows, df = corpus(spark, 60)
    model, counts = lm_scoring.learn(lm_scoring._texts(df, "doc_id", "text"))
    leaves, words = model.leaves, [bytes(r["word"]) for r in counts.collect()]
    state = np.random.RandomState(0).standard_normal((1, gru.HIDDEN)).astype(np.float32)
    p = np.exp(gru.leaf_log_probs(model.params, np.repeat(state, gru.LEAVES, 0), np.arange(gru.LEAVES)))
    assert p.sum() == pytest.approx(1, abs=1e-4)
    ids = model.vocabulary.encode(words)[:-1]
    leaf = leaves.leaves(ids)
    c = {bytes(r["word"]): r["c"] for r in counts.collect()}
    share = collections.Counter()
    for w, k in zip(words, leaf.tolist(), strict=True):
        if not leaves.single[k]:
            share[k] += (c[w] + 0.5) / 10 ** leaves.shared_log[k]
    for k, s in share.items():
        assert s + 0.5 / 10 ** leaves.shared_log[k] == pytest.approx(1, abs=1e-6)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from quernel.llm import decontamination, packing, quality_rules, queries, secret_scan, simhash_neardup

    r = random.Random(12)
    prose = lambda n: " ".join(r.choice(["the", "of", "and", "some", "word", "here"]) + str(r.randrange(50)) for _ in range(n))
    item = prose(25)
    rows = [(i, prose(150), "en", "s", 1) for i in range(30)]
    rows += [(100, rows[0][1], "en", "t", 1), (101, f"{prose(80)} {item} {prose(80)}", "en", "s", 1), (102, "short", "en", "s", 1), (103, prose(100) + " token = 1eb9c654e721b4f812088970e66a6345cee33dd6", "en", "s", 1), (104, None, None, None, None)]
    odd = prose(90)
    rows += [(0, prose(120), "en", "u", 1), (None, odd, "en", "u", 1), (None, f"{odd} {item}", "en", "u", 1), (None, "short", "en", "u", 1), (5, "short", "en", "u", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("clash") for c in ("node", "text_key", "_text_key", "_secrets", "kept")}).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert name == "packing" or docs.columns == columns
        seen.append({x["doc_id"] for x in docs.collect()})
        if name == "secret_scan":
            assert {x["doc_id"] for x in docs.where(F.contains("text", F.lit(secret_scan.MARK))).collect()} == {103}
    clean = set(range(30)) | {103, None}
    assert docs.where("doc_id = 0 AND start = 0").count() == 2 and docs.where("doc_id IS NULL AND start = 0").count() == 1 and docs.where("doc_id = 5 AND start = 0").count() == 1
    assert seen == [clean | {100, 101}, clean | {101}, clean, clean, clean]
    assert {x["doc_id"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()} == clean
    assert set(queries.QUERIES) == {*(f"op{n}_{k}" for n, k in enumerate(["license_scan", "html_extraction", "warc", "secret_scan", "decontamination", "quality_rules", "simhash_neardup", "language_id", "packing", "lm_scoring"], 1)), "pipeline"}
    assert all(m.query for m in (decontamination, packing, quality_rules, secret_scan, simhash_neardup))


def test_every_training_document_is_learned(spark, monkeypatch):
    """No document is drawn: groupings and the corpus round read them all, whatever the size of the start."""
    monkeypatch.setattr(lm_scoring, "START_TOKENS", 1)
    rows, df = corpus(spark, 120)
    training = lm_scoring._texts(df, "doc_id", "text").where("NOT held_out")
    texts = [bytes(r["text"]).lower().split() for r in training.collect()]
    c = collections.Counter(w for t in texts for w in t)
    order = sorted(c, key=lambda w: (-c[w], w))[:200]
    v = lm_scoring.Vocabulary(order, np.array([c[w] for w in order] + [len(texts)]))
    sent = spark.sparkContext.broadcast(v)
    near, weight = lm_scoring.company(training, sent)
    want, total = collections.Counter(), collections.Counter()
    own = order[: lm_scoring.OWN_LEAVES - 1]
    for t in texts:
        for i, w in enumerate(t):
            if w not in own:
                total[lm_scoring.suffix_code(w)] += 1
                want.update((lm_scoring.suffix_code(w), own.index(x)) for x in [*t[max(0, i - 5) : i], *t[i + 1 : i + 6]] if x in own)
    assert {k: int(weight[k]) for k in np.flatnonzero(weight)} == dict(total)
    assert {(int(a), int(b)): int(near[a, b]) for a, b in zip(*np.nonzero(near), strict=True)} == dict(want)
    leaves = lm_scoring.Leaves(v, near, weight, lambda so_far: lm_scoring.followers(training, sent, so_far))
    p = gru.new_params(leaves.inputs, np.ones(gru.LEAVES))
    got = lm_scoring.refine(training.coalesce(1), sent, leaves, p)
    pieces = [x for t in texts for x in lm_scoring._pieces(v.encode(t))]
    assert sum(map(len, pieces)) == sum(len(t) + 1 for t in texts)
    all_of_them = gru.train(p, leaves.described(pieces), rate=lm_scoring.TRAIN_RATE, epochs=1, lanes=lm_scoring.TRAIN_LANES)[0]
    assert all(np.allclose(got[k], x, atol=1e-3) for k, x in all_of_them.items())
    assert not all(np.allclose(p[k], x, atol=1e-3) for k, x in all_of_them.items())
