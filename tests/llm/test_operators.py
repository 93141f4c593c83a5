"""The dealt operators against brute force, library results and edge cases."""

import hashlib
import random
import re
import time
import weakref
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rigcast.llm import (bpe, crosspoly, html_text, jaccard, langid, nbsvm, packing, quality_rules, reply_trees, revisits, wordstats)
from rigcast.llm.common import components, stage
from rigcast.llm.textnum import chunks

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t", "a", "a b c d", "é ü ß", "x" * 70_000, "w " * 30_000, "%%% ### $$$", "1 2 3", "<|im_end|>",
       "one two three four five six", "one two three four five six", "One Two three FOUR five six"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, row string, id long, q string"


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, f"s{i % 3}" if i % 4 else None, 0, 1, "r", 9, "q") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rows = docs(spark, ODD)
    return rows.union(rows.where("doc_id in (3, 11)")).union(rows.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))


def test_nearest_brute_force_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 16)))]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [1.0, 2.0]), (2005, []), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cls", F.lit(1))
    got = {}
    for r in crosspoly.nearest(df, df.where("vec_id % 20 = 0 or vec_id > 1999"), top=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = {i: np.array(v) for i, v in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)}
    assert set(got) == {i for i in good if i % 20 == 0}
    hits = total = 0
    for q, found in got.items():
        want = sorted((-(good[q] * v).sum(), i) for i, v in good.items() if i != q)[:5]
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert all(abs(s - (good[q] * good[i]).sum()) < 1e-9 for _, i, s in found)
        hits += len({i for _, i in want} & {f[1] for f in found})
        total += len(want)
    assert hits / total >= 0.9
    assert crosspoly.nearest(df.limit(0), df).count() == 0


def test_recall_on_the_table(spark):
    found = {}
    for r in crosspoly.op1_cross_polytope(spark, SF).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    hit = sum(len(found[q] & {i for _, i in sorted((-(rows[q] @ v), i) for i, v in rows.items() if i != q)[:20]}) for q in found)
    assert crosspoly.SCAN < len(rows)                     # so the table is hashed
    assert set(found) == {i for i in rows if i % 20 == 0} and hit >= 0.9 * 20 * len(found)


def recall(spark, x, asked, top=20):
    """Share of the true ``top`` that is found, and the fewest rows found for a query."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {i: set() for i in asked}
    for r in crosspoly.nearest(df, df.where(F.col("vec_id").isin(asked)), top=top).collect():
        found[r.query_id].add(r.vec_id)
    hit = 0
    for q in asked:
        score = x @ x[q]
        score[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-score)[:top].tolist()))
    return hit / (top * len(asked)), min(map(len, found.values()))


def test_recall_with_uneven_lengths(spark):
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(3000, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    one, uneven = unit.copy(), unit * np.exp(rng.normal(size=(3000, 1)))
    one[17] *= 20
    for x in (one, uneven):
        share, fewest = recall(spark, x, list(range(0, 3000, 50)))
        assert share >= 0.9 and fewest == 20


def test_every_query_gets_all_it_can(spark, monkeypatch):
    rng = np.random.default_rng(6)
    for n in (2, 5, 20):
        assert recall(spark, rng.normal(size=(n, 64)), list(range(n)), top=n - 1) == (1.0, n - 1)
    x = rng.normal(size=(60, 256))
    x /= np.linalg.norm(x, axis=1)[:, None]
    # an id with many vectors: not one of its rows is an answer, and the others are found
    rows = [(i, v.tolist()) for i, v in enumerate(x[:30])] + [(0, (x[0] + 0.01 * v).tolist()) for v in x[30:]] + [(50, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = spark.createDataFrame([(0, x[0].tolist())], "vec_id long, embedding array<double>")
    want = [50] + [i for _, i in sorted((-(x[0] @ x[i]), i) for i in range(1, 30))]
    for scan in (1000, 10):                            # met whole; hashed, so queries reach few rows
        monkeypatch.setattr(crosspoly, "SCAN", scan)
        found = sorted((r["rank"], r.vec_id) for r in crosspoly.nearest(df, one, top=20).collect())
        assert found == list(enumerate(want[:20], 1))
    assert recall(spark, x, list(range(0, 60, 7)), top=59) == (1.0, 59)


@pytest.mark.parametrize("scan", [1000, 10])
def test_ties_go_to_the_smaller_id(spark, monkeypatch, scan):
    """Different vectors of one score, more than can be kept, stored with the largest ids first."""
    monkeypatch.setattr(crosspoly, "SCAN", scan)
    rng = np.random.default_rng(8)
    x = np.c_[np.ones(400), rng.choice([-1.0, 1.0], size=(400, 15))]
    rows = [(400 - i, v.tolist()) for i, v in enumerate(np.unique(x, axis=0))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = spark.createDataFrame([(999, [1.0] + [0.0] * 15), (rows[-1][0], [1.0] + [0.0] * 15)], "vec_id long, embedding array<double>")
    found = {}
    for r in crosspoly.nearest(df, one, top=5, probes=32).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    least = sorted(i for i, _ in rows)
    assert found == {999: least[:5], least[0]: least[1:6]}


def base_figures(t):
    w = WORD.findall(t or "")
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    cover = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)} if len(w) < 2000 else (set(range(len(w))) if len(set(w)) == 1 else set())
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover))


def test_word_figures():
    texts = ODD + ["x\ny\nx\n x\nx", "a b c d e a b c d e z", "\x85 \xa0"]
    got = wordstats.text_stats(texts)
    for i, t in enumerate(texts):
        assert tuple(int(got[c][i]) for c in quality_rules.STATS) == tuple(base_figures(t)[j] for j in range(5)), t[:50] if t else t


def test_quality_rules(spark, odd):
    got = quality_rules.quality(odd).collect()
    assert len(got) == odd.count() and not any(r.kept for r in got if r.n_words < 10)
    assert quality_rules.quality(odd.limit(0)).count() == 0
    rows = {r.doc_id: r for r in quality_rules.op2_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    judged = [(rows[i].kept, q) for i, q in label.items() if not rows[i].base_failed]
    assert sum(k == bool(q) for k, q in judged) >= 0.97 * len(judged)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(20000) < 0.8
    right = rng.random((20000, len(quality_rules.RULES))) < 0.85
    vote = np.where(right, good[:, None], ~good[:, None])
    text = np.where(rng.random(vote.shape) < 0.3, "-", vote.astype(int).astype(str))
    pats, counts = np.unique(["".join(r) for r in text], return_counts=True)
    post, model = quality_rules.fit_em(pats.tolist(), counts.tolist())
    assert abs(model["good"] - 0.8) < 0.02 and np.abs(model["right"] - 0.85).max() < 0.03
    assert quality_rules.fit_em([], [])[0].size == 0


def test_classifier(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    got = nbsvm.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in nbsvm.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert nbsvm.classify(odd.limit(0), labels).count() == 0
    rows = nbsvm.op3_nb_svm(spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.r_[rng.integers(0, 40, 10), 50 if i % 2 else 51]) for i in range(200)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(200)])
    w, b = nbsvm.dual_descent(rows, y, np.ones(60))
    assert all((w[r].sum() / np.sqrt(len(r)) + b) * t > 0 for r, t in zip(rows, y))


def test_packed_features_round_trip():
    rng = np.random.default_rng(3)
    for _ in range(40):
        own = [np.sort(rng.choice(nbsvm.WIDTH, n, replace=False)) for n in rng.choice([0, 1, 3, 60, 2000, nbsvm.WIDTH], rng.integers(0, 6))]
        first = np.r_[0, np.cumsum([len(x) for x in own])].astype(np.int64)
        packed = nbsvm.pack(np.concatenate([*own, np.empty(0, np.int64)]).astype(np.int64), first)
        assert [nbsvm.unpack(x).tolist() for x in packed] == [x.tolist() for x in own]


def test_reply_trees(spark):
    rows = [("t", "1", None, "system", "root", 0.0), ("t", "2", "1", "user", "a\\<|im_end|>\n", 1.0), ("t", "3", "2", "assistant", "<|x\\", 5.0),
            ("t", "4", "2", "assistant", None, 9.0), ("t", "5", "4", None, "tail", -3.0), ("u", "1", "9", "assistant", "", None),
            ("c", "1", "2", "user", "loop", 0.0), ("c", "2", "1", "user", "loop", 0.0), (None, "1", None, "user", "x", 0.0)]
    df = spark.createDataFrame(rows, "tree string, msg string, parent string, role string, text string, score double").withColumn("node", F.lit(1))
    got = {(r.tree, r.branch): r for r in reply_trees.format_trees(df, branches=None).collect()}
    assert set(got) == {("t", 1), ("t", 2), ("u", 1), (None, 1)}
    assert reply_trees.read_back(got["t", 1].formatted) == [("system", "root"), ("user", "a\\<|im_end|>\n"), ("assistant", ""), ("", "tail")]
    best = got["t", 2]
    assert [reply_trees.unescape(best.formatted[s.start:s.end]) for s in best.loss] == ["<|x\\"]
    assert reply_trees.format_trees(df.limit(0)).count() == 0
    chain = spark.createDataFrame([("k", str(i), str(i - 1) if i else None, "user", str(i), 0.0) for i in range(70)], df.drop("node").schema)
    assert [t for _, t in reply_trees.read_back(reply_trees.format_trees(chain).first().formatted)] == [str(i) for i in range(70)]


def test_escapes_round_trip():
    rng = random.Random(1)
    for _ in range(500):
        turns = [("".join(rng.choice("\\<|n\nu") for _ in range(3)), "".join(rng.choice("\\<|>n\nim_endstart") for _ in range(30))) for _ in range(3)]
        assert reply_trees.read_back(reply_trees.format_turns(turns)[0]) == turns


def shingle_set(t):
    w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(texts):
    sets, up = {i: shingle_set(t) for i, t in texts.items()}, {i: i for i in texts}
    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_components(spark, odd):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(3000)]
    texts = []
    for f in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 30, 200]))]
        for _ in range(12):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 12))):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            texts.append(" ".join(t))
    texts += [t.upper() for t in texts[:5]] + ODD
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, texts)).collect()}
    assert got == brute_components(dict(enumerate(texts)))
    rows = jaccard.jaccard_components(odd).collect()
    assert len(rows) == odd.count() and [r for r in rows if r.doc_id is None][0].component_id is None
    assert jaccard.jaccard_components(odd.limit(0)).count() == 0


def test_jaccard_splits_large_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rng = random.Random(9)
    base = [f"v{i}" for i in range(80)]
    texts = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(80)] = f"z{rng.randrange(500)}"
        texts.append(" ".join(t))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, texts)).collect()}
    assert got == brute_components(dict(enumerate(texts)))


def test_jaccard_parts_follow_the_text(spark, odd, monkeypatch):
    want = sorted(map(tuple, jaccard.jaccard_components(odd).collect()), key=str)
    monkeypatch.setattr(jaccard, "PART", 5_000)            # some 30 hash ranges instead of 8
    assert sorted(map(tuple, jaccard.jaccard_components(odd).collect()), key=str) == want


def test_jaccard_chance_tokens_of_long_documents_do_not_meet(spark, monkeypatch):
    rng = random.Random(12)
    vocab, line, texts = [f"w{i}" for i in range(5000)], [f"common{i}" for i in range(14)], []
    for _ in range(20):                                    # pairs of near copies; a line that all have links nothing
        base = [rng.choice(vocab) for _ in range(90)] + line
        texts += [" ".join(base), " ".join([*base, "end"])]
    kept, stage = {}, jaccard.stage
    monkeypatch.setattr(jaccard, "stage", lambda df, name: kept.setdefault(name, []).append(stage(df, name)) or kept[name][-1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, texts)).collect()}
    assert got == brute_components(dict(enumerate(texts))) and len({c for _, c in got.values()}) == 20
    assert kept["met"][0].count() == 0


@pytest.mark.parametrize("ranges", [1, 8, 64])
def test_jaccard_reachable_sets_by_brute_force(spark, monkeypatch, ranges):
    monkeypatch.setattr(jaccard, "RANGES", 4 * ranges)
    rng = random.Random(ranges)
    sets = [sorted(rng.sample(range(400), rng.randint(1, 40))) for _ in range(300)]
    comp = [rng.randrange(30) for _ in sets]
    held = {}
    for s, c in zip(sets, comp):
        for t in s:
            held.setdefault(t, set()).add(c if t > 120 else 0)          # tokens up to 120 are in one component only
    sets = [[t for t in s if t > 120 or c == 0] or [1000 + i] for i, (s, c) in enumerate(zip(sets, comp))]
    wide = lambda t: (t * 0x9E3779B97F4A7C15) % 2**64
    rows = [(bytes([i // 256, i % 256]) * 8, c, len(s), np.sort(np.array([wide(t) for t in s], np.uint64)).tobytes())
            for i, (s, c) in enumerate(zip(sets, comp))]
    found = {r.key for r in jaccard.reachable(spark.createDataFrame(rows, "key binary, comp long, n long, tokens binary").repartition(3), 75, 100).collect()}
    for (key, c, n, _), s in zip(rows, sets):
        assert (bytes(key) in {bytes(k) for k in found}) == (100 * sum(len(held.get(t, {c})) > 1 for t in s) >= 75 * n)


def test_stage_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "/shuffle_" in f}
    before = files()
    out = stage(spark.range(5000).repartition(7, "id").groupBy(F.col("id") % 50).count(), "few")
    deadline = time.time() + 15
    while files() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not files() - before and out.count() == 50


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(50, 51), (51, 50), (60, 60)], "a long, b long")
    got = {r.node: r.comp for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 21 for i in range(21, 41)}, 50: 50, 51: 50}


def test_revisits(spark):
    rows = [(1, "http://A.com/x?b=2&a=1&utm_source=z#f", 10, "response", 200, {"ETag": '"1"', "Content-Type": "t"}, "p1"),
            (2, "https://www.a.com:443/x/?a=1&b=2", 20, "revisit", 304, {"etag": 'W/"1"', "Content-Type": "n", "Expires": "e"}, None),
            (3, "http://a.com/x?a=1&b=2", 10, "revisit", 304, {"etag": '"1"'}, None),
            (4, "http://a.com/x?a=1&b=2", 99999, "revisit", 304, {"etag": '"2"'}, None),
            (5, "http://a.com/x?a=1&b=2", 50, "revisit", 304, None, None), (6, None, 50, "revisit", 304, {}, None),
            (7, "http://a.com/x?a=1&b=2", 15, "response", 206, {"ETag": '"9"'}, "p7"), (8, "http://b.com", None, "revisit", 304, {}, None)]
    df = spark.createDataFrame(rows, "record_id long, url string, captured long, kind string, status int, headers map<string,string>, body string").withColumn("key", F.lit(1))
    got = {r.record_id: r for r in revisits.resolve(df, carry=("body",)).collect()}
    assert {i: r.outcome for i, r in got.items()} == {2: "resolved", 3: "missing", 4: "mismatch", 5: "unchecked", 6: "missing", 8: "missing"}
    assert got[2].payload_id == 1 and got[2].body == "p1" and got[2].headers == {"etag": 'W/"1"', "content-type": "t", "expires": "e"}
    assert revisits.resolve(df.limit(0)).count() == 0


def test_html(spark):
    page = """<html><head><title>no</title></head><body class="with-sidebar"><header>Site</header><nav>Menu</nav><div class="cookie-notice">Eat</div>
      <div id="wrap"><article><header><h1>Head &amp; line</h1></header><p>First,  para<br>graph &lt;ok&gt;&nbsp;x<p>Second <a href='#'>link</a> here
      <script>if (a < b) "</p>"</script><aside>side</aside><ul><li>one<li>two</ul></article><div class="comments"><p>I think, that, this, is, long, enough.</p></div>
      <form>f</form></div><footer>foot</footer></body></html>"""
    assert html_text.main_text(page) == "Head & line\nFirst, para graph <ok> x\nSecond link here\none\ntwo"
    plain = "<div class=top><a href=1>a</a> <a href=2>b</a></div><div class=body><p>Some text, with commas, and more.<p>Again some text, yes.</div>"
    assert html_text.main_text(plain) == "Some text, with commas, and more.\nAgain some text, yes."
    for bad in ("", None, "<", "<p", "<a b='", "a < b", "</p></div>", "<!-- x", "<script>x", "<p>" * 5000 + "deep"):
        html_text.main_text(bad)
    rows = spark.createDataFrame([(1, "u", page, 0), (None, None, None, 0), (1, "u", page, 0)], "page_id long, url string, html string, text int")
    got = html_text.extract(rows).collect()
    assert sorted(r.n_chars for r in got) == [0, len(html_text.main_text(page)), len(html_text.main_text(page))]
    assert html_text.extract(rows.limit(0)).count() == 0


def test_language_id(spark, odd):
    got = langid.identify(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2, 8, 9)} == {"und"}
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(odd.limit(0)).count() == 0
    rows = langid.op8_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def odd_strings():
    rng = random.Random(2)
    marks = "aaabc  \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u3000'sstrell'd日本語éΣσ½²٣🙂\u0301\u0130AZ190"
    return (["".join(rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(800)]
            + ["<|endoftext|>", "x<|endoftext|> y<|startoftext|>", "a" * 4000, " " * 300, "", "don't I'll", "é e\u0301"])


def test_bpe_matches_the_library(spark, odd):
    path, lib = public_tokenizers.path("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    texts = odd_strings()
    own = bpe.ByteBpe(path)
    ids, n = own.encode(texts)
    cut = np.split(ids, np.cumsum(n)[:-1])
    want = lib.encode_batch(texts, add_special_tokens=False)
    assert [c.tolist() for c in cut] == [e.ids for e in want]
    assert [d.decode() for d in own.decode(ids, n)] == lib.decode_batch([e.ids for e in want], skip_special_tokens=False)
    own.together = False
    assert own.merge_words([b"aaaa", b"hello", b""])[1].sum() == len(lib.encode("aaaa", add_special_tokens=False).ids) + len(lib.encode("hello", add_special_tokens=False).ids)
    got = bpe.encode_decode(odd, path, arrays=True).collect()
    text = {i: t or "" for i, t in enumerate(ODD)} | {None: ODD[4]}
    for r in got:
        e = lib.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.ids == e and r.decoded == text[r.doc_id] and r.n_tokens == len(e)
        assert r.ids_sha256 == hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()
    assert len(got) == odd.count() and bpe.encode_decode(odd.limit(0), path).count() == 0


def test_white_space_tokenizer_matches_the_library():
    lib, texts = library("word_bpe_49k.json"), odd_strings()
    own = packing.WhiteSpaceTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    own.words.limit = own.parts.limit = 500
    for part in (texts[:400], texts[400:], texts[:400]):
        ids, n = own.encode(part)
        assert [c.tolist() for c in np.split(ids, np.cumsum(n)[:-1])] == [e.ids for e in lib.encode_batch(part, add_special_tokens=False)]


@pytest.mark.parametrize("later", [lambda b: chunks([b], "text"), lambda b: packing._pieces(64, False)(iter([]))])
def test_a_worker_lets_the_tokenizer_go(later):
    """Tasks of the tokenizing step share it; a task of any later step does not carry its tables."""
    path = public_tokenizers.path("word_bpe_49k.json")
    b = pa.RecordBatch.from_pydict({"doc_id": [1, None], "q": ["", "sa"], "text": ["a few words", None]})
    first = [list(packing._tokenize(path, 2)([b])) for _ in range(2)]
    held = weakref.ref(packing.load(path))
    assert first[0] == first[1] and list(packing._tokenize(path, 2)([b])) == first[0] and held() is not None
    list(later(b))
    assert held() is None
    assert list(packing._tokenize(path, 2)([b])) == first[0]


@pytest.mark.parametrize("targets", [None, {"s0": 1, "s1": 3, "s2": 1, "": 1}])
def test_packing(spark, odd, targets):
    rows = odd if targets is None else odd.withColumn("source", F.coalesce("source", F.lit("")))
    path, lib = public_tokenizers.path("word_bpe_49k.json"), library("word_bpe_49k.json")
    out = packing.pack(rows, path, seq_len=64, granule=16, targets=targets, with_ids=True)
    got = out.collect()
    by_seq = {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k, parts in by_seq.items():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([x for _, x in parts])[:-1]]
        assert sum(x for _, x in parts) == 64 or k == max(by_seq)
    assert sorted(by_seq) == list(range(len(by_seq)))
    text = {i: t or "" for i, t in enumerate(ODD)} | {None: ODD[4]}
    total = sum(len(lib.encode(text[r.doc_id], add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert sum(r.length for r in got) == total
    for i in (6, 7, 12):
        parts = sorted((r.start, r.ids) for r in got if r.doc_id == i)
        assert np.frombuffer(b"".join(p for _, p in parts), "<u4").tolist() == lib.encode(text[i], add_special_tokens=False).ids + [2]
    assert packing.assemble(out).count() == len(by_seq)
    assert packing.pack(rows.limit(0), path).count() == 0


def test_packing_is_gapless_at_a_block_border(spark):
    """A share a hair below a third: 8,192 granules are due just after round 1,536, which ends a block."""
    rows = spark.createDataFrame([(i, "a " * 1200, "third" if i % 3 == 0 else "rest") for i in range(30)], "doc_id long, text string, source string")
    got = packing.pack(rows, public_tokenizers.path("word_bpe_49k.json"), seq_len=16, granule=1,
                       targets={"third": 2381.424169, "rest": 4762.84834}).collect()
    at = 0
    for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 16 + p.offset == at
        at += p.length
    assert at == sum({p.doc_id: p.doc_tokens for p in got}.values())


def test_packing_needs_a_weight_for_each_source(spark, odd):
    with pytest.raises(ValueError):
        packing.pack(odd, public_tokenizers.path("word_bpe_49k.json"), targets={"s0": 1.0})


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    lang = corpus_pipeline.language(spark, rows, sf)
    keep = corpus_pipeline.quality(spark, rows, sf)
    near = corpus_pipeline.near_duplicates(spark, rows.union(rows), sf)
    assert lang.columns == keep.columns == near.columns == rows.columns
    want = {r.doc_id for r in quality_rules.quality(rows).where("kept").collect()}
    assert {r.doc_id for r in keep.collect()} == want
    brute = brute_components({r.doc_id: r.text for r in rows.collect()})
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for _, c in brute.values()})
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, rows.limit(0), sf).count() == 0, name
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_near_duplicates_judge_rows_not_ids(spark):
    a, near_a, other = ("w%d " * 40 % tuple(range(40))), ("w%d " * 40 % (*range(39), 99)), "another text of its own with quite other words"
    rows = [(1, a), (5, a), (5, other), (7, near_a + "z"), (7, near_a), (8, ""), (8, ""), (8, " "), (None, a), (None, a), (9, None)]
    rows += [(20, "p " + other.upper()), (20, "o " + other.upper() + " p q"), (21, "p " + other.upper())]
    alone = [(30, x + " ".join(f"k{i}" for i in range(50))) for x in ("c ", "b ", "b ", "d ")]
    df = spark.createDataFrame(rows + alone, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, df, None).collect()), key=str)
    linked = brute_components({i: t for i, (d, t) in enumerate(rows + alone) if d is not None})
    best = {}
    for i, (_, comp) in linked.items():
        best.setdefault(comp, []).append(i)
    all_rows = rows + alone
    want = {min(((all_rows[i]) for i in ids), key=lambda r: (r[0], r[1] or "")) for ids in best.values()} | {(None, a)}
    assert (5, other) in want and (30, alone[1][1]) in want
    assert got == sorted(want, key=str)


def test_language_stage_without_labels(spark, odd):
    rows = odd.withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.language(spark, rows, None)
    assert got.columns == rows.columns
    assert sorted(r.text for r in got.collect()) == sorted(r.text for r in rows.collect() if r.text and re.search(r"[^\W\d_]", r.text))
