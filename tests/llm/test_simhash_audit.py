"""SimHash near-duplicates and the filter audit against brute force."""

import random
import re
from itertools import combinations, permutations

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rigcast.llm import filter_audit, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t", "a", "a b", "a b c", "A B C", "a b c d", "é ü ß", "x" * 70_000, "w " * 3_000, "%%% ### $$$", "UPPER CASE",
       "one two three four five six", "one two three four five six", "One Two three FOUR five six", "pipe | here " * 60]
DOCS = "doc_id long, text string, lang string, source string, fp long, comp long, part string, digest string, mask long, c long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, 1, "p", "d", 2, 3) for i, t, lang in rows], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = WORD.findall(lower(text))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Smallest id reachable, of rows ``(id, fingerprint)``."""
    up = {f: f for f in {f for _, f in prints}}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in combinations(up, 2):
        if (a ^ b).bit_count() <= 3:
            up[find(a)] = find(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, f"{f:016x}", least.get(find(f))) for i, f in prints), key=str)


def test_fingerprints(monkeypatch):
    texts = [t for t in ODD if t is None or len(t) < 10_000] + ["B c  d\te\nf g h " * 9 + "ö É"]
    want = [fingerprint(t) for t in texts]
    assert simhash.fingerprints(texts).tolist() == want
    monkeypatch.setattr(simhash, "PIECE", 7)               # every longer text in pieces
    assert simhash.fingerprints(texts).tolist() == want
    assert simhash.fingerprints([]).tolist() == []


def test_bit_counts_beyond_a_lane():
    h = np.random.default_rng(1).integers(0, 2**64, 2000, dtype=np.uint64)
    upto = np.array([0, 0, 700, 700, 2000])
    want = [[sum(int(x) >> b & 1 for x in h[s:e]) for b in range(64)] for s, e in zip(upto, upto[1:])]
    assert simhash.bit_counts(h, upto).tolist() == want


def test_simhash_on_the_table(spark):
    got = [tuple(r)[:3] for r in simhash.op12_simhash(spark, SF).collect()]
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(got, key=str) == classes([(r.doc_id, fingerprint(r.text)) for r in rows])


def test_simhash_odd_rows(spark):
    rows = [(i, t, None) for i, t in enumerate(ODD)] + [(None, "a b c", "x"), (None, "only without id", "x"), (3, "a", "x"), (3, "other words here", "x")]
    got = [tuple(r) for r in simhash.simhash_components(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == classes([(i, fingerprint(t)) for i, t, _ in rows])
    assert simhash.simhash_components(docs(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("cell, hot", [(2048, 1000), (64, 1000), (64, 2)])
def test_crowded_cells_lose_no_link(spark, monkeypatch, cell, hot):
    """Dense balls of fingerprints: cells far above their limit are cut again, hot or not."""
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "HOT_SHARE", hot)
    rng = random.Random(cell + hot)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice((2, 3, 5, 6)))) for _ in range(150)}
    prints |= {x ^ 7 for x in list(prints)[:40]} | {0, 1, 2**64 - 1}
    df = spark.createDataFrame([(simhash.signed(x),) for x in prints], "fp long").cache()
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.close_links(df).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    up = {x: x for x in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in found:
        up[find(a)] = find(b)
    assert all(find(a) == find(b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 3)


def test_blocks_cover_and_grow():
    for n, blocks in ((10, 4), (200_000, 4), (10**6, 5), (10**9, 6), (6 * 10**10, 7)):
        masks = simhash.tables(n)
        assert len({m for m in masks}) == len(masks) == len(list(combinations(range(blocks), blocks - 3)))
        for bits in ((0, 21, 63), (1, 2, 3), (15, 16, 32)):
            assert any(not any(m >> b & 1 for b in bits) for m in masks)
    assert sum(simhash.cut_bits((1 << 64) - 1, 4)) == (1 << 64) - 1
    free = 48
    for _ in range(6):
        free = max(free - x.bit_count() for x in simhash.cut_bits((1 << free) - 1, 4))
    assert 1 << free <= simhash.CELL


# ------------------------------------------------------------- filter audit

def brute_audit(rows, labels):
    """Applies the filters one after another in every order."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = {f for f, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), i is not None and i > least[t])) if bad}
        docs.append((lang or "", fails, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        own, shapley = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = own
            for n, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                steps.append((part, "".join(order), n, len(left), len(gone), sum(f in d[1] for d in own) - len(gone),
                              sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def test_audit_against_filters_applied_in_turn(spark):
    rng = random.Random(4)
    words = ["alpha", "Beta", "GAMMA", "delta", "x|y", "ö"] + [f"w{i}" for i in range(120)]
    texts = [" ".join(rng.sample(words, rng.randint(90, 125))) for _ in range(30)]
    texts += [" ".join(rng.choices(words[:40], k=rng.randint(90, 140))) for _ in range(20)]
    rows = [(i, rng.choice(texts + ODD), rng.choice(["en", "de", "", None, "xx"])) for i in range(150)]
    rows += rows[:20] + [(None, texts[0], "en"), (None, None, None), (5, texts[1], "de"), (5, texts[2], "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(4, 1, 1), (None, 1, 1)]
    marks = spark.createDataFrame([(*x, "en", "p") for x in labels], "doc_id long, quality int, toxic int, lang string, part string")
    got = sorted(tuple(r) for r in filter_audit.audit(docs(spark, rows), marks).collect())
    assert got == brute_audit(rows, labels)
    assert filter_audit.audit(docs(spark, rows).limit(0), marks).collect() == []
    one = filter_audit.audit(docs(spark, [(1, "a | b", "en")]), marks.limit(0)).collect()
    assert len(one) == 600 and {r.kept for r in one if r.step == 5} == {0}


def test_audit_sql(spark):
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(filter_audit.OP13_SQL)
    got = filter_audit.op13_filter_audit(spark, SF)
    assert set(want.columns) == set(got.columns)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())


def test_potential_is_the_average_over_orders():
    v = filter_audit.removal_game([random.Random(9).randint(0, 50) + p for p in range(32)])
    pot = filter_audit.potentials(v)
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[:order.index(i)])
            total += v[before | 1 << i] - v[before]
        assert pot[31] - pot[31 ^ 1 << i] == total


def test_hot_documents_only_shift_the_plan(spark):
    rows = [(i, "the same text again", "en") for i in range(300)] + [(1000 + i, f"text number {i} of many words", "de") for i in range(100)]
    got = {r.doc_id: r.component_id for r in simhash.simhash_components(docs(spark, rows)).collect()}
    assert len(got) == 400 and {got[i] for i in range(300)} == {0}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") is not None
    assert docs(spark, rows).where(F.col("doc_id") < 0).count() == 0


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_hot_join_is_a_join(spark, monkeypatch, share):
    from rigcast.llm import common
    monkeypatch.setattr(common, "HOT_SHARE", share)
    rows = spark.createDataFrame([(i, 0 if i % 2 else i % 11) for i in range(200)], "id long, k long")
    keyed = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 5").withColumn("name", F.concat(F.lit("n"), "k"))
    got = common.hot_join(rows, keyed, "k", "n", 200)
    want = rows.join(keyed.drop("n"), "k")
    assert sorted(map(tuple, got.select("k", "id", "name").collect())) == sorted(map(tuple, want.select("k", "id", "name").collect()))


@pytest.mark.parametrize("share", [3, 1000])
def test_simhash_hot_and_cold_prints_agree(spark, monkeypatch, share):
    from rigcast.llm import common
    monkeypatch.setattr(common, "HOT_SHARE", share)
    monkeypatch.setattr(simhash, "HOT_SHARE", share)
    rows = [(i, ODD[i % len(ODD)] if i % 3 else "one text that a third of all rows share", None) for i in range(90)]
    got = [tuple(r) for r in simhash.simhash_components(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == classes([(i, fingerprint(t)) for i, t, _ in rows])
