"""Operators with work in numpy or plain Python, against brute force."""

import random
import re
import string
import time
from collections import Counter
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from paystrata.llm import (
    bpe, decontaminate, html_text, ngram_join, suffix_dedup, texthash, toxicity,
)
from paystrata.llm.queries import QUERIES, vocabulary
from tests.llm import brute


def check_groups(frame):
    texts = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    expected = brute.groups(texts)
    key = lambda x: tuple((v is not None, v) for v in x)
    result = [tuple(r) for r in ngram_join.judge(frame).select("doc_id", "n_shingles", "component_id").collect()]
    wanted = [(texts[i][0], n, c) for i, (n, c) in expected.items()]
    assert sorted(result, key=key) == sorted(wanted, key=key)


def edited(generator, words, rate):
    return " ".join(w if generator.random() > rate else f"e{generator.randint(0, 9**9)}" for w in words)


def test_groups_of_documents(documents):
    check_groups(documents)


def test_groups_odd(odd, nothing):
    check_groups(odd)
    assert ngram_join.judge(nothing).count() == 0
    assert ngram_join.keep_one(odd).columns == odd.columns
    assert ngram_join.keep_one(nothing).count() == 0


def test_groups_near_the_bound(spark):
    generator = random.Random(5)
    texts = []
    for _ in range(30):
        base = [f"w{generator.randint(0, 10**6)}" for _ in range(generator.randint(6, 200))]
        texts += [edited(generator, base, generator.choice([0, 0.01, 0.02, 0.03, 0.04])) for _ in range(12)]
        # chains of growing texts, whose ends do not link
        texts += [" ".join(base[: max(1, len(base) * k // 8)]) for k in range(3, 9)]
    shared = " ".join(f"s{i}" for i in range(60))
    texts += [shared + " " + " ".join(f"u{i}x{k}" for k in range(30)) for i in range(80)]
    check_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_keep_one(documents, rows):
    kept = {r["doc_id"] for r in ngram_join.keep_one(documents).select("doc_id").collect()}
    assert kept == {c for _, c in brute.groups(rows).values()}


def test_leaks(spark, documents, folder, rows):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    result = {r["doc_id"]: r["items"] for r in decontaminate.judge(documents, benchmark).collect()}
    expected = {d: brute.leaks(t, items) for d, t in rows}
    assert result == expected
    assert any(expected.values())


def test_leaks_edited(spark, odd, nothing):
    generator = random.Random(9)
    vocabulary_ = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(generator.choices(vocabulary_, k=n))) for i, n in enumerate([1, 3, 5, 20, 40, 41, 70, 300])]
    items += [(8, items[4][1]), (9, None), (10, "")]
    texts = []
    for _, item in items[:9]:
        for rate in (0, 0.01, 0.03, 0.06):
            filler = lambda: " ".join(generator.choices([f"f{i}" for i in range(900)], k=generator.randint(0, 80)))
            texts.append(f"{filler()} {edited(generator, item.split(), rate)} {filler()}")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    result = {r["doc_id"]: r["items"] for r in decontaminate.judge(frame, benchmark).collect()}
    assert result == {i: brute.leaks(t, items) for i, t in enumerate(texts)}
    clean = decontaminate.remove(odd, benchmark)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert decontaminate.judge(odd, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontaminate.judge(nothing, benchmark).count() == 0


def test_index_misses_nothing_in_the_radius():
    generator = np.random.Generator(np.random.PCG64(1))
    texts = [" ".join(f"t{generator.integers(0, 400)}" for _ in range(30)).encode() for _ in range(50)]
    index = decontaminate.Index(list(enumerate(texts)))
    for bits in index.prints:
        flips = generator.permutation(64)[: decontaminate.RADIUS]
        other = bits.copy()
        other[flips] ^= True
        near = set(np.flatnonzero((index.prints != other).sum(axis=1) <= decontaminate.RADIUS).tolist())
        assert index.near(other) == near and near


def library(texts):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(vocabulary())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    ids = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    return ids, [tokenizer.decode(i, skip_special_tokens=False) for i in ids]


def test_bpe_of_documents(spark, documents, rows):
    ids, decoded = library([t or "" for _, t in rows])
    result = {r["doc_id"]: r for r in bpe.digest(documents, vocabulary()).collect()}
    for (d, _), i, t in zip(rows, ids, decoded):
        r = result[d]
        assert r["n_tokens"] == len(i)
        assert r["ids_sha256"] == brute.sha(",".join(map(str, i)))
        assert r["decoded_sha256"] == brute.sha(t)


def test_bpe_strange_texts(odd, nothing):
    generator = random.Random(2)
    alphabet = "aaabbe thTH'sé1 2\n\t  ß漢字🙂.,!-_=#　\x00ÀÑ٣՘"
    texts = ["".join(generator.choices(alphabet, k=generator.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 3000, "<|endoftext|>x<|endoftext|>", " " * 700, "ab" * 3000, ""]
    texts += ["".join(chr(generator.choice([generator.randint(0, 0x2FF), generator.randint(0, 0xD7FF),
                                          generator.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(1000)]
    machine = bpe.automaton(vocabulary())
    ids, decoded = library(texts)
    assert [machine.encode(t) for t in texts] == ids
    assert [machine.decode(i) for i in ids] == decoded
    whole = bpe.encode(odd, vocabulary()).collect()
    assert [r["decoded"] for r in whole] == [r["text"] or "" for r in odd.collect()]
    assert bpe.digest(nothing, vocabulary()).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="home"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>%s<aside>More</aside>
<section id="comments"><p>first comment, and a long one it is, with many words in it</p></section>
<form><input value="x"><label>Mail</label></form><footer>&copy; 2020</footer></body></html>"""


@pytest.mark.parametrize("body, text", [
    ("<article><h1>A &amp; B</h1><p>One\n two&nbsp;<b>three</b></p><p>x</p></article>", "A & B\nOne two three\nx"),
    ("<article><p><b>open<br><p>next</p>tail</article>", "open\nnext\ntail"),
    ("<main><article><p>Text &lt;tag&gt;</p><div class='share'>Share</div><ul><li>a<li>b</ul></article></main>", "Text <tag>\na\nb"),
    ("<div id='content'><p>" + "A long paragraph of prose. " * 9 + "</p><p>Short.</p></div>",
     ("A long paragraph of prose. " * 9).strip() + "\nShort."),
    ("", ""),
])
def test_main_text(body, text):
    assert html_text.main_text(PAGE % body) == text


TALE = "A long paragraph of prose with more than ten words in it. " * 5


@pytest.mark.parametrize("html, text", [
    ("<div class='layout with-sidebar'><div class='sidebar'><article>Other tale</article></div>"
     "<article><p>One</p></article></div>", "One"),
    ("<form id='aspnetForm'><nav>Menu</nav><article><p>One</p><form>Mail</form></article></form>", "One"),
    ("<div id='header'><main><p>One</p></main></div>", "One"),
    ("<div id='header'><nav>Menu</nav><article><p>" + TALE + "</p></article></div>", TALE.strip()),
    ("<page-frame class='has-banner'><article><p>One</p></article></page-frame>", "One"),
    ("<form><nav>Menu</nav><div id='content'><p>" + TALE + "</p></div><footer>2020</footer></form>", TALE.strip()),
    ("<div class='with-sidebar'><p>" + TALE + "</p><div class='sidebar'>Side</div></div>", TALE.strip()),
    ("<article><h2 id='related-work'>Related work</h2><section id='navigation'><h3 class='header-files'>Files</h3>"
     "<p>One <span class='side'>side</span> and <a class='widget' href='#'>two</a>.</p></section>"
     "<section id='sharing'><p>S</p></section><div id='widget-api'><p>W</p></div>"
     "<div class='share-links'>Share</div><ul class='social'><li>Like</ul></article>",
     "Related work\nFiles\nOne side and two.\nS\nW"),
    ("<article><p>One</p><div id='comments'><article class='comment-body'><p>First</p></article></div></article>", "One"),
    ("<article><p>One</p></article><div id='comments'><article><p>First</p></article></div>", "One"),
    ("<main><p>One</p><section id='comments'><p>First</p></section></main>", "One"),
    ("<div id='content'><p>" + TALE + "<b class='side'>end</b></p></div>", TALE + "end"),
    ("<form><label>Mail</label><input></form>", ""),
])
def test_main_text_in_wrappers(html, text):
    assert html_text.main_text(f"<html><body>{html}</body></html>") == text


@pytest.mark.parametrize("html, text", [
    # unmarked pages: parts under one parent stay together, but not blocks of links
    (f"<section><p>{TALE}</p></section><section><p>Short.</p></section><section><p>{TALE}</p></section>",
     f"{TALE.strip()}\nShort.\n{TALE.strip()}"),
    (f"<div><h1>Title</h1></div><div><p>{TALE}</p><p>{TALE}</p></div><div><p>The end.</p></div>",
     f"Title\n{TALE.strip()}\n{TALE.strip()}\nThe end."),
    (f"<div><a href='/'>Home</a> <a href='/b'>About us</a></div><div><div><h1>Title</h1></div><div><p>{TALE}</p></div>"
     f"<div><p>{TALE}</p></div></div><div>Links: <a href='/c'>Contact and more</a></div>",
     f"Title\n{TALE.strip()}\n{TALE.strip()}"),
    # blocks inside an article
    ("<article><p>One</p><section id='comments'><p>First</p></section><p class='advert'>Buy</p>"
     "<section class='ad'>Buy</section><ins class='adsbygoogle'>Buy</ins><p class='cookie-notice'>We bake</p>"
     "<p class='adverb header-text'>Two</p><section id='ad-hoc'>Three</section>"
     "<p>Sum <math><mi>x</mi><annotation>\\x</annotation></math></p><noscript><p>Four</p></noscript></article>"
     "<noscript>Turn it on</noscript>", "One\nTwo\nThree\nSum x\nFour"),
])
def test_main_text_of_parts(html, text):
    assert html_text.main_text(f"<html><body>{html}</body></html>") == text


@pytest.mark.parametrize("html", [
    "<div><b>" * 40_000 + "x" + "</i>" * 40_000, "<b>" * 40_000 + "<div>x</div>" * 40_000,
    "<div>word " * 40_000, "<p><b>" * 40_000 + "x", "<a href='/'>x</a>" * 40_000,
])
def test_long_pages_in_linear_time(html):
    start = time.monotonic()
    assert html_text.main_text(html) is not None
    assert time.monotonic() - start < 10


def plain_page(html, marks):
    """(article by its tags, the page with those marks taken away)."""
    body = html.split("<article>")[1].split("</article>")[0]
    blocks = re.split(r"</?(?:h1|p|ul|li|div)[^>]*>", re.sub(r"<br ?/?>", " ", body))
    lines = [" ".join(unescape(re.sub(r"</?(?:b|a|i|em)\b[^>]*>", "", x)).split()) for x in blocks]
    for mark in marks:
        html = html.replace(f"<{mark}>", "<div>").replace(f"</{mark}>", "</div>")
    return "\n".join(x for x in lines if x), html


@pytest.mark.parametrize("marks", [(), ("article",), ("article", "nav", "footer")])
def test_pages_without_marks(spark, folder, marks):
    """Words of the articles found and words found that are theirs, over all pages."""
    asked = found = right = 0
    for row in spark.read.parquet(f"{folder}/pages.parquet").select("html").collect():
        text, html = plain_page(row["html"], marks)
        result = html_text.main_text(html)
        if not marks:
            assert result == text
        a, b = Counter(text.split()), Counter(result.split())
        asked, found, right = asked + a.total(), found + b.total(), right + (a & b).total()
    print(f"marks removed {marks}: recall {right / asked:.4f}, precision {right / found:.4f}")
    assert right / asked > 0.95 and right / found > 0.95


def test_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    result = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    assert len(result) == pages.count()
    for page in pages.collect():
        r = result[page["page_id"]]
        assert r["url"] == page["url"] and r["n_chars"] == len(r["text"]) > 0
        assert "track(" not in r["text"] and "©" not in r["text"]
        ad = page["html"].split('<div class="ad">')[1].split("</div>")[0]
        body = page["html"].split("<article>")[1].split("</article>")[0]
        assert ad in body or " ".join(ad.split()) not in r["text"].split("\n")
    strange = spark.createDataFrame(
        [(1, None, None, 1), (2, "u", "", 1), (2, "u", "", 1), (3, "u", "<<>&#x;<p", 1), (4, "u", "plain", 1),
         (5, "u", "<article>" + "<p>x</p>" * 20000, 1), (6, "u", "<div>" * 5000 + "deep", 1)],
        "page_id long, url string, html string, text int",
    )
    texts = {r["page_id"]: r["text"] for r in html_text.extract(strange).collect()}
    assert texts[1] == texts[2] == "" and texts[4] == "plain"
    assert texts[5].count("x") == 20000 and texts[6] == "deep"
    assert html_text.extract(strange.limit(0)).count() == 0


def test_toxicity_on_held_out_rows(spark, folder, odd, nothing):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    result = toxicity.judge(documents, labels)
    assert result.count() == documents.count()
    held = result.where("held_out").join(labels, "doc_id").toPandas()
    good = ((held.predicted == 1) == (held.toxic == 1)).mean()
    assert good > 0.93
    assert held[held.predicted == 1].toxic.mean() > 0.9
    larger = folder.replace("sf0.01", "sf0.1")  # with 120 toxic rows held out
    labelled = spark.read.parquet(f"{larger}/labels.parquet")
    many = toxicity.judge(spark.read.parquet(f"{larger}/documents.parquet"), labelled)
    many = many.where("held_out").join(labelled, "doc_id").toPandas()
    assert many[many.toxic == 1].predicted.mean() > 0.8
    assert many[many.predicted == 1].toxic.mean() > 0.9
    blank = spark.createDataFrame([], labels.schema)
    assert toxicity.judge(odd, blank).where("score <> 0").count() == 0
    assert toxicity.judge(nothing, labels).count() == 0
    assert toxicity.judge(odd, labels).where("score is null").count() == 0


def test_harmless_labels_are_not_learnt(spark, small):
    """With the prior given, the labels of harmless texts change nothing."""
    documents = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    documents = documents.union(documents)  # copies count once
    weights, bias = toxicity.fit(documents, labels, 0.1)
    fewer, same = toxicity.fit(documents, labels.where("toxic = 1"), 0.1)
    assert (weights == fewer).all() and bias == same
    drawn = toxicity.sample(documents, labels)
    assert not drawn.where(toxicity.is_held_out(drawn.doc_id)).count()
    assert drawn.groupBy("doc_id", "toxic").count().where("count > 1").count() == 0


def test_shared_beginnings_of_words():
    """Texts with one of no words, beginnings of few and of several different words."""
    one, empty, several = toxicity.features([b"abcdef abcdef", b"", b"abcdxy abcdzz other"])
    assert len(one) == 1 and len(empty) == 0  # a repeated word does not share its beginning
    assert len(several) == 4  # three words, and a beginning of four bytes that two share
    assert [len(f) for f in toxicity.features([b"word " * 400_000, b"x"])] == [1, 1]


def test_non_negative_risk_stops_overfitting():
    generator = np.random.Generator(np.random.PCG64(4))
    noise = [generator.integers(100, 4000, 30) for _ in range(400)]
    positive = [np.append(n, 5) for n in noise[:40]]
    unlabelled = noise[40:] + [np.append(generator.integers(100, 4000, 30), 5) for _ in range(40)]
    weights, bias = toxicity.train(positive, unlabelled, 0.1)
    fresh = generator.integers(4000, 9000, 30)
    assert toxicity._scores([np.append(fresh, 5)], weights, bias)[0] > toxicity._scores([fresh], weights, bias)[0] + 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_source_divergence"}))
def test_every_query_covers_its_table(spark, small, name):
    table = "pages" if name.startswith(("op2_", "op10_")) else "documents"
    whole = spark.read.parquet(f"{small}/{table}.parquet").count()
    assert QUERIES[name](spark, small).count() == whole


def check_repeats(frame):
    texts = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    expected = brute.repeats({i: t for i, (_, t) in enumerate(texts)})
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    key = lambda x: tuple((v is not None, v) for v in x)
    result = [tuple(r[c] for c in columns) for r in suffix_dedup.digest(frame).collect()]
    assert sorted(result, key=key) == sorted(((texts[i][0], *v) for i, v in expected.items()), key=key)


def test_repeats_of_documents(spark, small):
    check_repeats(spark.read.parquet(f"{small}/documents.parquet"))


def passages(generator, count):
    letter = lambda n: "".join(generator.choices("abcdé f", k=n))
    shared = [letter(n) for n in (300, 399, 400, 401, 450, 700, 1500)]
    texts = []
    for _ in range(count):
        parts = []
        for _ in range(generator.randint(1, 4)):
            passage = generator.choice(shared)
            cut = generator.randint(0, len(passage) // 2) if generator.random() < 0.5 else 0
            parts += [letter(generator.randint(0, 300)), passage[cut:]]
        texts.append("".join(parts))
    return texts + [letter(5000), "ab" * 700, "q" * 1500, "q" * 399, texts[0], texts[0] + "x", "x" + texts[0]]


def test_repeats_at_all_borders(spark):
    texts = passages(random.Random(8), 120)
    check_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_repeats_in_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 10)
    texts = passages(random.Random(18), 60)
    check_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_anchors_of_one_bucket_stay_dealt(spark, monkeypatch):
    """op1, round 3: runs of one byte have an anchor of one bucket at every place."""
    generator = random.Random(28)
    letter = lambda n: "".join(generator.choices("abcdé f", k=n))
    texts = [letter(200) + "q" * 3000 + letter(200) for _ in range(16)] + passages(generator, 20)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    cut, shares = suffix_dedup.cut, {}

    def share(rows):
        counts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        return max(counts) / sum(counts)

    def watched(rows, purpose):
        if purpose == "shared-anchors":
            shares[purpose] = share(rows)
        return cut(rows, purpose)

    monkeypatch.setattr(suffix_dedup, "cut", watched)
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.files.openCostInBytes": "128m",  # a file a task
    }
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        whole = suffix_dedup.repeated_ranges(frame).where(f"low = 0 and high = {suffix_dedup.REACH}")
        shares["equal surroundings"] = share(whole)
        check_repeats(frame)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(shares.values()) < 0.4, shares


def test_repeats_odd(odd, nothing):
    check_repeats(odd)
    assert suffix_dedup.digest(nothing).count() == 0


def thue_morse(order, a="a", b="b"):
    word, other = a, b
    for _ in range(order):
        word, other = word + other, other + word
    return word, other


def test_strings_that_sums_do_not_tell_apart_stay(spark):
    """Equal ends, and between them a Thue-Morse word and its complement."""
    for seed in range(12):
        random.seed(seed)
        ends = ["".join(random.choices(string.ascii_lowercase, k=200)) for _ in range(2)]
        texts = [ends[0] + middle + ends[1] for middle in thue_morse(8)]
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        expected = brute.repeats(dict(enumerate(texts)))
        result = {r["doc_id"]: r for r in suffix_dedup.digest(frame).collect()}
        assert {d: tuple(r)[1:5] for d, r in result.items()} == expected
        assert all(r["n_removed"] == 0 and r["spans"] == "" for r in result.values())


def test_planted_passages_are_caught_and_clean_texts_left(spark):
    """Passages of 400 to 700 bytes at random places in two to nine texts; others share less."""
    random.seed(8)

    def words(count):
        return " ".join("".join(random.choices(string.ascii_lowercase, k=random.randrange(2, 9))) for _ in range(count))

    texts, planted = [], set()
    for n in range(60):
        passage = words(200)[: random.randrange(400, 701)]
        for _ in range(random.randrange(2, 10)):
            planted.add(len(texts))
            texts.append(f"{words(random.randrange(1, 120))} {passage} {words(random.randrange(1, 120))}")
    for n in range(300):
        short = words(80)[:399]
        texts += [f"{words(90)}{'ab'[k]}{short}{'yz'[k]}{words(90)}" for k in range(2)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    caught = {r["doc_id"] for r in suffix_dedup.digest(frame).collect() if r["n_removed"] >= 400}
    assert caught == planted


def test_words_that_sums_do_not_tell_apart_are_not_linked(spark):
    texts = list(thue_morse(10)) + [f"{x} y z v w" for x in thue_morse(4)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r["component_id"] == r["doc_id"] for r in ngram_join.judge(frame).collect())


def test_hashes_of_runs():
    """Equal runs have equal hashes wherever they stand; no two different ones met here share one."""
    random.seed(2)
    words = {"".join(random.choices("ab\x00", k=random.randrange(1, 20))).encode() for _ in range(5000)}
    words |= {w + b"\x00" for w in words}
    words = sorted(words)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    found = texthash.run_hashes(data, starts, ends)
    assert len(set(found.tolist())) == len(words)
    again = texthash.run_hashes(np.concatenate((data[:5], data)), starts + 5, ends + 5)
    assert (found == again).all()
