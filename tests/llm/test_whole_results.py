"""Results that a cut once left out: near copies in large buckets, texts with a recurring line, article text, edited test items."""

import functools
import itertools
import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_corpus_ops import VOCABULARY, plain_aligned, prose

from scriptoria.llm import common, decontaminate, html_extract, neardup


def variants(rng, n, fewest, most):
    """Edited copies of one absent text."""
    base = prose(rng, 300).split()
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(300), rng.randint(fewest, most)):
            words[at] = "".join(rng.choices(VOCABULARY, k=2))
        out.append(" ".join(words))
    return out


def joined_by_all_pairs(texts, shingles_of):
    """The root of each text when every pair is aligned."""
    hasher = common.WordHasher()
    shingles = [shingles_of(hasher([t])[0]) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if find(i) != find(j) and neardup.aligned(shingles[i], shingles[j]) > 0:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_all_pairs_of_large_buckets(spark, monkeypatch):
    texts = variants(random.Random(11), 900, 3, 9)
    expected = joined_by_all_pairs(texts, neardup.labelled_shingles)
    assert 100 < len(set(expected)) < 890
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for members in (4096, 50):  # a bucket at once, and in blocks
        monkeypatch.setattr(neardup, "BLOCK_MEMBERS", members)
        got = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
        assert [got[i] for i in range(len(texts))] == expected


def test_parities_exclude_no_pair():
    rng = np.random.default_rng(12)
    for n in (5, 40, 300):
        a = neardup.mix64(rng.integers(0, 1 << 60, n).astype(np.uint64))
        for k in range(n + 1):
            b = np.concatenate([a[k:], neardup.mix64(rng.integers(0, 1 << 60, k // 2).astype(np.uint64))])
            x, y = neardup.parities([a, b], 64)
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_alignment_of_repeated_shingles():
    rng = random.Random(13)
    for _ in range(400):
        a = [rng.randrange(rng.choice((2, 6, 40))) for _ in range(rng.randint(1, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 2)] = [rng.randrange(8)] * rng.randint(0, 2)
        exact = plain_aligned(a, b)
        got = neardup.aligned(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got == pytest.approx(exact if exact >= 0.8 - 1e-12 else 0.0)


@pytest.mark.parametrize("length", [8, 12, 20])
def test_copies_with_a_recurring_line(spark, length):
    rng = random.Random(14)
    line, parts = prose(rng, length), [prose(rng, 12) for _ in range(25)]
    whole = "\n".join(f"{line}\n{p}" for p in parts)
    df = spark.createDataFrame([(1, whole), (2, whole[len(line) + 1 :]), (3, prose(rng, 300))], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()} == {1: 1, 2: 1, 3: 3}


def test_items_with_one_word_changed():
    rng = random.Random(15)
    items = [(i, prose(rng, 40) + ". " + prose(rng, rng.randint(5, 10)) + ".") for i in range(20)]
    index, hasher = decontaminate.ItemIndex(items), common.WordHasher()
    for i, text in items:
        words = text.split()
        for at in range(40, len(words)):
            changed = " ".join([*words[:at], "changed", *words[at + 1 :]])
            doc = f"{prose(rng, 30)} {changed} {prose(rng, 30)}"
            passage = hasher([doc])
            assert decontaminate.overlap(index.items[i].words, passage[0]) >= 0.8
            assert i in [h[1] for h in decontaminate.hits(index, *passage)]
        question = f"{prose(rng, 30)} {' '.join(words[:40])} {prose(rng, 30)}"
        assert not decontaminate.hits(index, *hasher([question]))


LONG = "".join(f"<p>Sentence {i} of the story goes on for a while.</p>" for i in range(30))


def test_article_text_outside_the_winner():
    lead = "<div class=lead><p>" + "The lead tells in short what happened. " * 12 + "</p></div>"
    text = html_extract.extract(f"<body>{lead}<div class=content>{LONG}</div></body>", {})
    assert text.startswith("The lead") and text.count("\n") == 30
    assert html_extract.extract(f"<main><h1>Title</h1><article>{LONG}</article></main>", {}).startswith("Title\nSentence 0")


@pytest.mark.parametrize("around", ["div class='layout with-sidebar'", "div class='has-banner page'", "form", "app-root class='no-menu'", "div class=sidebar"])
def test_chrome_that_holds_the_article(around):
    page = f"<body><div class=ad>Buy</div><{around}><article>{LONG}<div class=share-bar>Tell all</div></article><div class=sidebar>Side</div></{around.split()[0]}><nav>Home</nav></body>"
    text = html_extract.extract(page, {})
    assert text.startswith("Sentence 0") and text.count("\n") == 29


def test_chrome_beside_the_article():
    page = f"<body><div class=content>{LONG}</div><div id=comments><article>A comment</article></div><span class=tags>x</span><aside class=related><article>Other</article></aside></body>"
    assert html_extract.extract(page, {}).count("\n") == 29


def test_junk_that_a_host_repeats(spark):
    page = "<body><div class=top><p>About this house</p></div><div class=intro><p>Lead {0}</p></div><div class=content>" + LONG.replace("story", "story {0}") + "</div></body>"
    df = spark.createDataFrame([(i, "http://h/", page.format(i // 2)) for i in range(6)], "page_id long, url string, html string")
    for limit in (1 << 20, -1):
        for r in html_extract.extract_pages(df, broadcast_bytes=limit).collect():
            assert r["text"].startswith(f"Lead {r['page_id'] // 2}\nSentence 0") and r["text"].count("\n") == 30


@pytest.mark.parametrize(
    "part, kept",
    [
        ("<p title='the hidden valley'>Part</p>", True),
        ("<p><img alt='role=navigation'>Part</p>", True),
        ("<p class='notice-period'>Part</p>", True),
        ("<p>Formula <math><mi>Part</mi></math> end</p>", True),
        ("<fieldset><legend>Part</legend></fieldset>", True),
        ("<p hidden>Part</p>", False),
        ("<div class='cookie-notice'>Part</div>", False),
        ("<p class='notice'>Part</p>", False),
        ("<div id='comments' width='100'><p>Part</p></div>", False),
        ("<div role=navigation>Part</div>", False),
        ("<form><p>Part</p></form>", False),
        ("<div data-x='a > b' class=ad>Part</div>", False),
    ],
)
def test_attributes_and_parts_of_an_article(part, kept):
    text = html_extract.extract(f"<body><article>{LONG}{part}</article><footer>x</footer></body>", {})
    assert ("Part" in text) == kept and text.count("goes on") == 30


CHROME_ALONE = ["<body><nav>Home About</nav><footer>Copyright X</footer></body>", "<div class='cookie-notice'>We use cookies</div>", "<body><div class='sidebar'><p>Side</p></div></body>"]


@pytest.mark.parametrize("page", CHROME_ALONE)
def test_pages_of_chrome_alone_have_no_text(page):
    assert html_extract.extract(page, {}) == ""


def test_words_and_parts_of_an_article_stay():
    """Words of a line whatever their class, parts and paragraphs whose names only sound like chrome; lists of links under such names go."""
    page = f"""<body><nav>Home</nav><article><p>we <span class="social">love</span> <em class="share">networks</em> a <b class="alert">lot</b><i hidden>not</i></p>
    <div class="foot-care"><p>Care for feet</p></div><section class="notice-period"><p>A month</p></section><p class="banner">Banners of old</p><p class="tags">Tags on sheep</p>
    <div class="related-work">Work</div><div class="related-posts"><a href=x>One</a> <a href=y>Two</a></div><div class="share-buttons">Tell</div>{LONG}<div class="feedback"><p>I do not like it</p></div></article></body>"""
    text = html_extract.extract(page, {})
    lines = text.split("\n")
    assert lines[:6] == ["we love networks a lot", "Care for feet", "A month", "Banners of old", "Tags on sheep", "Work"]
    assert lines[6].startswith("Sentence 0") and len(lines) == 36
    assert html_extract.extract(f"<body><div class=content>we <span class=social>love</span> it<p>and <b class=alert>that</b></p>{LONG}</div><span class=tags>x</span></body>", {}).startswith("we love it\nand that\nSentence 0")


def test_a_paragraph_of_links_and_words_outside_the_winner():
    half = "<p>See <a href=x>the long list of all that was said about it</a> for more of this.</p>"
    menu = "<div><a href=a>One</a> <a href=b>Two</a></div>"
    text = html_extract.extract(f"<body>{menu}<div class=lead>{half}</div><div class=content>{LONG}</div></body>", {})
    assert text.startswith("See the long list") and text.count("\n") == 30
    assert "See the long" not in html_extract.extract(f"<body><div class=lead>{half}</div><div class=content>{LONG}</div></body>", {}, {html_extract.text_key("See the long list of all that was said about it for more of this.")})


HOSTILE = {"nested": "<div>", "nested text": "<div>x", "stray ends": "</i></b></p></div>", "open and stray": "<b></i>", "items": "<li>a</li>", "chrome": "<div class=ad>x", "paragraphs": "<p>a", "cells": "<tr><td>", "quotes": "<a '\">", "comment": "<!-- ", "amp": "&amp", "articles": "<article>x"}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_hostile_markup_takes_time_in_proportion(name):
    """A megabyte of nested or unclosed tags, alone and inside many others: four times the page takes about four times as long, and little memory."""
    import time
    import tracemalloc

    def seconds(size):
        page = "<b>" * (size // 40) + "<div>" * (size // 40) + HOSTILE[name] * (size // len(HOSTILE[name])) + "</b>"
        took = []
        for _ in range(2):
            began = time.thread_time()
            html_extract.extract(page, {})
            took.append(time.thread_time() - began)
        return min(took)

    few, many = seconds(250_000), seconds(1_000_000)
    assert many < 6 and many < 8 * few + 0.3
    if name == "nested":
        tracemalloc.start()
        html_extract.extract(HOSTILE[name] * 200_000, {})
        assert tracemalloc.get_traced_memory()[1] < 200 << 20
        tracemalloc.stop()


def test_paths_with_many_classes_and_templates(spark):
    """Twelve templates of six classes each on one hot host: each page is read by its own template's path, sent or joined."""
    pages = []
    for k in range(12):
        names = " ".join(f"{chr(97 + k)}{c}" for c in "qrstuv")
        for i in range(3):
            body = LONG.replace("story", f"story {'abcdefghijkl'[k]} {'xyz'[i]}")
            pages.append((10 * k + i, "http://hot/", f"<body><div class='junk'><p>Junk beside {'abcdefghijkl'[k]}</p></div><div class='{names}'>{body}</div></body>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    paths = {r["path"] for r in html_extract.host_votes(df).where("path is not null").collect()}
    assert len(paths) == 12 and all(p.count(".") == 6 for p in paths)
    for limit in (1 << 20, -1):
        got = html_extract.extract_pages(df, broadcast_bytes=limit).collect()
        assert len(got) == 36 and all(r["text"].count("\n") == 29 and "Junk" not in r["text"] for r in got)


def plain_extraction(pages):
    """The vote and the second reading, page by page, on pages made of nested divisions with classes and paragraphs only."""
    import re

    def blocks(page):
        path, out = [], []
        for close, name, attr, text in re.findall(r"<(/?)(body|div|p)(?: class=(\w+))?>([^<]*)", page):
            if close:
                path.pop()
            else:
                path.append(re.sub(r"\d+", "0", f"{name}.{attr}" if attr else name))
            if text:
                out.append((tuple(x for x in path if not x.startswith("p")), text))
        return out

    def scores(found):
        total = sum(len(t) for _, t in found)
        out = {}
        for path in {p[:i] for p, _ in found for i in range(1, len(p) + 1)}:
            held = sum(len(t) for p, t in found if p[: len(path)] == path)
            if held >= 0.7 * total:
                out[path] = held / total + 0.4 * (".content" in path[-1]) + 0.02 * len(path)
        return out

    votes, beside = {}, {}
    for url, page in pages:
        found = blocks(page)
        own = scores(found)
        best = min(own, key=lambda p: (-own[p], ">".join(p)))
        votes[url, best] = votes.get((url, best), 0) + own[best]
        inner = "\n".join(t for p, t in found if p[: len(best)] == best)
        for p, t in found:
            if p[: len(best)] != best:
                beside.setdefault((url, t), set()).add(inner)
    out = []
    for url, page in pages:
        found = blocks(page)
        own = scores(found)
        told = [p for p in own if (url, p) in votes]
        best = min(told, key=lambda p: (-votes[url, p], ">".join(p))) if told else min(own, key=lambda p: (-own[p], ">".join(p)))
        out.append("\n".join(t for p, t in found if p[: len(best)] == best or len(beside.get((url, t), ())) < 2))
    return out


def test_generated_pages_against_a_plain_vote(spark):
    rng = random.Random(21)

    def division(depth):
        inner = "".join(division(depth - 1) if depth and rng.random() < 0.5 else f"<p>{prose(rng, rng.randint(1, 30)) if rng.random() < 0.8 else 'the same junk everywhere'}</p>" for _ in range(rng.randint(1, 3)))
        return f"<div class={rng.choice(['content', 'box', 'x1', 'x2', 'outer'])}>{inner}</div>"

    pages = [(i, f"h{i % 4}", f"<body>{''.join(division(3) for _ in range(rng.randint(1, 3)))}</body>") for i in range(120)]
    df = spark.createDataFrame([(i, f"http://{h}/", p) for i, h, p in pages], "page_id long, url string, html string")
    want = plain_extraction([(h, p) for _, h, p in pages])
    for limit in (1 << 20, -1):
        got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(df, broadcast_bytes=limit).collect()}
        assert [got[i] for i in range(120)] == want


def test_recall_against_all_pairs(spark):
    """A group of 600 partly similar copies, and texts that share only a header: pairs at 0.8 are in one class, the exact answer is that of all pairs, and hot buckets lose hardly any."""
    rng = random.Random(17)
    texts = variants(rng, 600, 3, 9)
    header = prose(rng, 60)
    texts += [f"{header} {prose(rng, 60)}" for _ in range(100)]
    shingles = [common.shingle_hashes(common.WordHasher()([t])[0], 5) for t in texts]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if neardup.aligned(shingles[i], shingles[j]) > 0]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = joined_by_all_pairs(texts, lambda w: common.shingle_hashes(w, 5))
    assert len(pairs) > 200
    assert {r["doc_id"]: r["class_id"] for r in neardup.classes(df, exact=True).collect()} == dict(enumerate(expected))
    nodes = {r["node"]: r["doc_id"] for r in df.select("doc_id", neardup.content("text").alias("node")).collect()}
    for hot in (neardup.HOT_MEMBERS, 40):
        root = {nodes[r["node"]]: r["root"] for r in neardup.links(df, hot_members=hot)[1].collect()}
        recall = sum(root.get(i, i) == root.get(j, j) for i, j in pairs) / len(pairs)
        assert recall >= 0.99, (hot, recall)


def test_pairs_that_meet_in_one_hot_bucket_only(spark, monkeypatch):
    """All texts agree in one sketch and in no other, and their bucket is hot: every pair at 0.8 is joined, by the rarest shingles, and no other."""
    rng = random.Random(29)
    header = prose(rng, 40)
    texts = []
    for _ in range(60):
        words = f"{header} {prose(rng, 60)}".split()
        texts.append(" ".join(words))
        at = rng.randrange(45, 95)
        texts.append(" ".join([*words[:at], "changed", *words[at + 1 :]]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(neardup, "_sketches", lambda docs: docs.select("node").distinct().withColumn("sketch", F.array(F.lit(7).cast("long"))))
    nodes = {r["node"]: r["doc_id"] for r in df.select("doc_id", neardup.content("text").alias("node")).collect()}
    roots = {nodes[r["node"]]: r["root"] for r in neardup.links(df, hot_members=20)[1].collect()}
    assert [roots.get(i, i) == roots.get(i + 1, i + 1) for i in range(0, len(texts), 2)] == [True] * 60
    assert len({roots[i] for i in range(0, len(texts), 2)}) == 60


def in_one_hot_bucket(monkeypatch):
    """All texts agree in one sketch and in no other, and a bucket of more than 20 is hot, whoever asks for links."""
    monkeypatch.setattr(neardup, "_sketches", lambda docs: docs.select("node").distinct().withColumn("sketch", F.array(F.lit(7).cast("long"))))
    monkeypatch.setattr(neardup, "links", functools.partial(neardup.links, hot_members=20))


def test_pipeline_keeps_one_of_each_pair_of_a_hot_bucket(spark, monkeypatch):
    """The pipeline's near_duplicates drops every near copy whose only common bucket is hot, and nothing else; texts that share a header of most of their words are not compared pair by pair."""
    rng = random.Random(31)
    header = prose(rng, 100)
    texts = []
    for i in range(200):
        words = f"{header} {prose(rng, rng.randint(15, 30))}".split()
        texts.append(" ".join(words))
        if i % 5 == 0:
            texts.append(" ".join([*words, "changed"]))
    expected = joined_by_all_pairs(texts, lambda w: common.shingle_hashes(w, 5))
    assert len(set(expected)) == 200
    docs = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int")
    in_one_hot_bucket(monkeypatch)
    dealt, compare = [], neardup._joined_in_buckets
    monkeypatch.setattr(neardup, "_joined_in_buckets", lambda members, shingled: dealt.append(members.select("bucket", F.size(F.collect_set("node").over(Window.partitionBy("bucket"))).alias("n")).agg(F.max("n")).first()[0]) or compare(members, shingled))
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, "").collect()) == sorted(set(expected))
    assert max(dealt) < 20


def test_hot_bucket_of_texts_of_all_lengths(spark, monkeypatch):
    """Beginnings of one text, edited and of all lengths, in one hot bucket: its classes are those of all pairs, at once and in blocks."""
    rng = random.Random(37)
    base = prose(rng, 160).split()
    texts = []
    for _ in range(240):
        words = base[: rng.randint(3, 160)]
        for at in rng.sample(range(len(words)), min(len(words), rng.choice((0, 1, 1, 2, 3)))):
            words[at] = "".join(rng.choices(VOCABULARY, k=2))
        texts.append(" ".join(words))
    texts = list(dict.fromkeys(texts))
    expected = joined_by_all_pairs(texts, lambda w: common.shingle_hashes(w, 5))
    assert 20 < len(set(expected)) < len(texts) - 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    in_one_hot_bucket(monkeypatch)
    for members in (4096, 10):
        monkeypatch.setattr(neardup, "BLOCK_MEMBERS", members)
        assert {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()} == dict(enumerate(expected))


def test_long_alignments_in_bands():
    rng = np.random.default_rng(18)
    for n, edits in ((700, 10), (700, 60), (300, 20)):
        a = rng.integers(0, 1 << 40, n).astype(np.uint64)
        a[rng.integers(0, n, n // 20)] = 7
        b = a.tolist()
        for at in sorted(rng.integers(0, n, edits).tolist(), reverse=True):
            b[at : at + int(rng.integers(0, 3))] = rng.integers(0, 1 << 40, int(rng.integers(0, 3))).tolist()
        b = np.array(b, np.uint64)
        exact = plain_aligned(a.tolist(), b.tolist())
        got = neardup.aligned(a, b)
        assert (got >= 0.8) == (exact >= 0.8) and got <= exact + 1e-12
        assert neardup._common(a, b, n) == round(exact * (len(a) + len(b)) / (1 + exact))
