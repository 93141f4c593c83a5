"""Contract cases of text extraction, language ID and packing against plain versions."""

import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rigcast.llm import html_text, langid, packing
from rigcast.llm.textnum import Flat

THREE = "".join(f"<p>Paragraph {i}, with commas, and enough words to count as a part of an article.</p>" for i in range(3))
LINES = "\n".join(f"Paragraph {i}, with commas, and enough words to count as a part of an article." for i in range(3))


@pytest.mark.parametrize("open_tag", [
    '<article class="post category-advertising">', '<article class="post tag-search">', '<div class="entry-content comments-open">',
    '<div class="has-sidebar no-comments">', '<div class="notice">', '<section id="social-history">', '<main class="search">'])
def test_class_words_do_not_cut_the_article(open_tag):
    tag = re.match(r"<(\w+)", open_tag)[1]
    page = f'<body><nav>Menu</nav>{open_tag}{THREE}</{tag}><div class="sidebar"><p>Side, text.</p></div><footer>foot</footer></body>'
    assert html_text.main_text(page) == LINES


@pytest.mark.parametrize("boiler", [
    '<div class="comments"><p>A comment, a very long one, with commas.</p></div>', '<section id="comment-list"><p>Reader, says, this.</p></section>',
    '<div class="widget_search">find</div>', '<div id="related-posts"><p>Other, texts, to read.</p></div>', '<div class="ad-slot">Buy, now</div>',
    '<p class="cookie-notice">We use, cookies.</p>', '<div role="navigation">a b</div>', '<div class="share-bar">Share</div>',
    '<div hidden><p>Not, seen.</p></div>', '<form><label>Name</label></form>', '<div class="newsletter-signup"><p>Sign, up.</p></div>'])
def test_parts_that_are_not_the_article_go(boiler):
    assert html_text.main_text(f"<body><article>{THREE}{boiler}</article></body>") == LINES
    assert html_text.main_text(f'<body><div class="content">{THREE}</div>{boiler}</body>') == LINES


def test_body_text_inside_the_article_stays():
    page = (f'<article>{THREE}<section id="social-history"><p>Social history, told.</p></section><p class="alert-level">Alert level, high.</p>'
            "<p>so <math>x = 2</math> holds</p></article>")
    assert html_text.main_text(page) == LINES + "\nSocial history, told.\nAlert level, high.\nso x = 2 holds"


@pytest.mark.parametrize("tag", ["div", "font", "li", "span", "blockquote"])
def test_deep_pages_take_linear_time(tag):
    times = []
    for depth in (5_000, 40_000):
        page = "<body>" + "".join(f"<{tag}>t{i}, " for i in range(depth)) + "</b></i>" * depth
        start = time.process_time()
        html_text.main_text(page)
        times.append(time.process_time() - start)
    assert times[1] < 30 * max(times[0], 0.02)


def test_articles_of_all_pages():
    """On every page with one article, the text is that of the article's blocks as a plain regular expression finds them."""
    import pyarrow.parquet as pq
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    checked = 0
    for html in pages:
        found = re.findall(r"<article[^>]*>(.*)</article>", html or "", re.S)
        if len(found) != 1:
            continue
        body = re.sub(r"<!--.*?-->", "", found[0], flags=re.S)
        body = re.sub(r"<(script|style|aside|form|nav|footer|figure)\b.*?</\1>", "\n", body, flags=re.S)
        body = re.sub(r"<br\s*/?>", " ", re.sub(r"\s+", " ", body))
        body = re.sub(r"</?(p|h[1-6]|ul|ol|li|div|section|blockquote|table|tr|td)\b[^>]*>", "\n", body)
        blocks = [" ".join(html_text.html.unescape(re.sub(r"<[a-z/][^>]*>", "", x)).split()) for x in body.split("\n")]
        assert html_text.main_text(html) == "\n".join(x for x in blocks if x)
        checked += 1
    assert checked >= 0.9 * len(pages)


# ---------------------------------------------------------------- language ID

def test_numerals_are_no_letters(spark):
    rows = [(i, t, "en") for i, t in enumerate(["²", "½", "①", "Ⅷ", "३", "_", "1 2", "a", "é", "中", "ª", "the end of it"] * 3)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all((got[i] == "und") == (t in "² ½ ① Ⅷ ३ _".split() + ["1 2"]) for i, t, _ in rows)


def test_landmarks_of_all_rows_give_plain_kernel_ridge():
    """With every row a landmark, the Nystrom solution is kernel ridge regression on the dense kernel of n-gram sets."""
    rng = np.random.default_rng(5)
    words = {"en": "the of and to in is you that it he was".split(), "fr": "le la les de des et un une est que qui".split()}
    rows = [(lang, " ".join(rng.choice(words[lang], 12))) for lang in ("en", "fr") for _ in range(15)]
    asked = [" ".join(rng.choice(words[lang], 9)) for lang in ("en", "fr", "fr")]

    def sets(texts):
        ids, first = langid.grams(texts)
        return [set(ids[s:e].tolist()) for s, e in zip(first, first[1:])]

    def kernel(a, b):
        return np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])

    own, other = sets([t for _, t in rows]), sets(asked)
    for text, found in zip(asked, other):                       # presence of hashed n-grams of the lower-cased bytes
        assert 0 < len(found) <= sum(max(len(text.encode()) + 1 - n + 1, 0) for n in langid.GRAMS) and Flat([text]).n == 1
    packed = []
    for s in own:
        bits = np.zeros(langid.WIDTH, np.uint8)
        bits[list(s)] = 1
        packed.append(np.packbits(bits).tobytes())
    ridge = 1e-3
    model = langid.train([lang for lang, _ in rows], packed, landmarks=len(rows), ridge=ridge)
    y = np.array([[1.0 if lang == m else -1.0 for m in ("en", "fr")] for lang, _ in rows])
    want = kernel(other, own) @ np.linalg.solve(kernel(own, own) + ridge * len(rows) * np.eye(len(rows)), y)
    ids, first = langid.grams(asked)
    got = np.add.reduceat(model.weight[ids], first[:-1], axis=0) / np.sqrt(np.diff(first))[:, None]
    assert np.allclose(got, want, atol=1e-3)


# ----------------------------------------------------------------- packing

def replay(totals, weights, seq_len, granule):
    """Deficit round-robin over plain queues: the source of every token of the stream."""
    whole = sum(weights.values())
    left, deficit, out = dict(totals), dict.fromkeys(totals, 0), []
    while any(left.values()):
        for q in sorted(left):
            if not left[q]:
                continue
            deficit[q] += seq_len * weights[q]
            while left[q] and deficit[q] >= min(granule, left[q]) * whole:
                n = min(granule, left[q])
                out += [q] * n
                left[q] -= n
                deficit[q] -= n * whole
    return out


@pytest.mark.parametrize("targets, granule", [(None, 16), (None, 5), ({"s0": 5, "s1": 2, "s2": 1}, 16)])
def test_the_stream_is_deficit_round_robin(spark, targets, granule):
    rng = np.random.default_rng(granule)
    sizes = {"s0": 4, "s1": 11, "s2": 25}
    rows = [(i, " ".join(["a"] * int(rng.integers(0, 60))), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seq_len = 64
    got = packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), seq_len=seq_len, granule=granule, targets=targets).collect()
    stream = []
    for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * seq_len + p.offset == len(stream)
        stream += [p.source] * p.length
    totals = {s: stream.count(s) for s in sizes}
    weights = totals if targets is None else {s: round(w * 1_000_000) for s, w in targets.items()}
    assert stream == replay(totals, weights, seq_len, granule)
    if targets is None:                                   # the stated bound, in every window of a sequence
        for s in sizes:
            share = totals[s] / len(stream)
            for at in range(0, len(stream) - seq_len + 1):
                held = sum(x == s for x in stream[at:at + seq_len])
                assert abs(held - share * seq_len) <= granule + share * (2 * seq_len + len(sizes) * granule)


def test_packing_leaves_the_session_as_it_was(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    assert packing.pack(df.withColumn("rid", F.lit(0)), public_tokenizers.path("word_bpe_49k.json")).count() == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
