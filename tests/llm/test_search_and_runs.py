"""Projection forest, periodic runs and ranked lexical search against plain versions."""

import hashlib
import math
import random
import re
import zlib

import cases
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from visitflow.llm import lexical_search, periodic_runs, projection_forest
from visitflow.llm.queries import ORACLE_SQL, QUERIES, planted

SF = "/root/testdata/sf0.001"


def twin(name, folder=SF):
    """Columns and sorted rows of a query's SQL."""
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    return columns, sorted(found.fetchall(), key=str)


def same_as_sql(spark, name):
    rows = QUERIES[name](spark, SF)
    columns, expected = twin(name)
    assert sorted(rows.columns) == sorted(columns)
    assert sorted(map(tuple, rows.select(columns).collect()), key=str) == expected
    return expected


# --- Projection forest ----------------------------------------------------------------------------


def vectors(seed, singles, clusters, dim=16, near=0.03):
    """Unit-like vectors: single ones, and clusters of given sizes around a centre."""
    rng = np.random.default_rng(seed)
    out = list(rng.standard_normal((singles, dim)))
    for size in clusters:
        centre = rng.standard_normal(dim)
        out += list(centre + near * np.linalg.norm(centre) / np.sqrt(dim) * rng.standard_normal((size, dim)))
    return [x.astype(np.float32).tolist() for x in out]


def plain_links(rows, cosine=0.9):
    """vec_id to (links, smallest reachable vec_id) by all pairs; ids are unique."""
    lead = {i: i for i, _ in rows}

    def top(x):
        while lead[x] != x:
            x = lead[x]
        return x

    links = dict.fromkeys(lead, 0)
    for k, (i, x) in enumerate(rows):
        for j, y in rows[:k]:
            a, b = (np.array([] if v is None else v, float) for v in (x, y))
            if len(a) == len(b) and len(a) and np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any():
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    p, q = top(i), top(j)
                    lead[max(p, q)] = min(p, q)
    return {i: (links[i], top(i)) for i in links}


def grouped(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    return projection_forest.near_groups(df)


@pytest.mark.parametrize("leaf, compared", [(512, 64), (40, 16)])
def test_links_equal_all_pairs(spark, monkeypatch, leaf, compared):
    """Small leaves make many rounds, dense leaves and blocks; no link is lost here and none counts twice."""
    monkeypatch.setattr(projection_forest, "LEAF", leaf)
    monkeypatch.setattr(projection_forest, "COMPARED", compared)
    data = vectors(1, 60, [60, 2, 3])
    rows = [(k, x) for k, x in enumerate(data + data[:5] + [data[70]] * 30)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in grouped(spark, rows).collect()}
    expected = plain_links([(i, np.array(x, np.float32)) for i, x in rows])
    assert got == expected
    assert max(n for n, _ in got.values()) > 80


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 3.0]), (5, [1.0, nan, 3.0]), (6, [inf, 1.0, 1.0]),
        (7, one), (8, [2.0, 4.0, 6.0]), (9, [1.0, 2.0]), (None, one), (11, [1e-300, 2e-300, 3e-300]), (12, [1e300, 2e300, 3e300]),
        (13, [-0.0, 0.0, 1.0]), (14, [0.0, -0.0, 2.0]), (20, one), (20, one), (21, [-1.0, -2.0, -3.0]),
    ]
    got = sorted(map(tuple, grouped(spark, rows, "double").collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 21)] + [(None, 0, None, True)]
    linked = [(i, 5, 7, i == 7) for i in (7, 8, 11, 12, 20, 20)] + [(13, 1, 13, True), (14, 1, 13, False)]
    assert got == sorted(alone + linked, key=str)
    assert grouped(spark, []).collect() == []


def test_forest_reads_no_other_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [1.0, 2.0], "b")], "vec_id long, embedding array<float>, lead string")
    for name in ("node", "tree", "bucket", "leaf", "links", "copies", "label"):
        df = df.withColumn(name, F.lit(name))
    got = sorted(map(tuple, projection_forest.near_groups(df).collect()))
    assert got == [(1, 1, 1, True), (2, 1, 1, False)]


def test_recall_of_pairs_at_the_threshold(spark, monkeypatch):
    """Pairs with a cosine just above 0.9 are the hardest to keep together; several levels of splits."""
    monkeypatch.setattr(projection_forest, "LEAF", 200)
    rng, data = np.random.default_rng(3), []
    for _ in range(500):
        x, y = rng.standard_normal((2, 32))
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        data += [x.tolist(), (0.905 * x + math.sqrt(1 - 0.905**2) * y).tolist()]
    got = grouped(spark, list(enumerate(data)), "double").agg(F.sum("n_links")).first()[0]
    units = np.array(data)
    exact = int((units @ units.T >= 0.9).sum()) - len(units)
    assert 0.9 * exact <= got <= exact


def test_registered_forest_equals_its_sql(spark):
    same_as_sql(spark, "op11_projection_forest")


# --- Periodic runs --------------------------------------------------------------------------------


def plain_runs(words, power=4, least=6):
    out = []
    for q in range(1, len(words)):
        k = q
        while k < len(words):
            if words[k] != words[k - q]:
                k += 1
                continue
            start = k - q
            while k < len(words) and words[k] == words[k - q]:
                k += 1
            own = words[start:k]
            smaller = any(all(own[x] == own[x - p] for x in range(p, len(own))) for p in range(1, q))
            if len(own) >= max(least, power * q) and not smaller:
                out.append((start, len(own), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text, edit=False):
    words = cases.words(text)
    if edit and doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (
        doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def random_words(rng):
    out = []
    while len(out) < rng.randrange(120):
        unit = [rng.randrange(rng.choice([2, 4, 40])) for _ in range(rng.randrange(1, 12))]
        out += (unit * 9)[: rng.randrange(1, 8 * len(unit) + 2)]
    return out


@pytest.mark.parametrize("power, least", [(2, 3), (3, 6), (4, 6), (4, 20)])
def test_runs_equal_all_periods(power, least):
    rng = random.Random(power * least)
    for _ in range(150):
        docs = [random_words(rng) for _ in range(rng.randrange(1, 5))]
        hashes = np.array([x for d in docs for x in d], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        first = np.cumsum([0] + [len(d) for d in docs])
        assert periodic_runs.runs_of(hashes, first, power, least) == [plain_runs(d, power, least) for d in docs]


def test_every_square_is_of_the_smallest_period():
    rng = random.Random(8)
    for _ in range(100):
        text = random_words(rng)
        for i, d in periodic_runs.squares(text, 2):
            own = text[i - 2 * d + 1 : i + 1]
            assert own[:d] == own[d:]
            assert not any(all(own[x] == own[x - p] for x in range(p, 2 * d)) for p in range(1, d))


def test_runs_of_hard_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TOGETHER", 2000)
    more = [
        "a a a a a a", "a a a a a", "a b " * 4 + "c", "x " + "p q r " * 5 + "p " + "p q r " * 5, "one two " * 3, "é ü " * 9 + "é",
        "w\x0bw\tw\r\nw w  w ", "w\xa0 w\xa0 " * 3, "A a A a A a A a", "q " * 3000,
    ]
    data = cases.rows(cases.TEXTS + more) + cases.rows(["y y y y y y y", None], [None, None]) + cases.rows(["z " * 7] * 2, [10, 10])
    docs = cases.with_clashes(cases.frame(spark, data)).withColumn("runs", F.lit(1)).withColumn("start", F.lit(2))
    got = periodic_runs.digests(periodic_runs.found_runs(docs)).collect()
    long = {r[0] for r in data if len(cases.words(r[1])) > 1000}  # all periods of these take too long
    expected = sorted((plain_digest(r[0], r[1]) for r in data if r[0] not in long), key=str)
    assert sorted((tuple(r) for r in got if r.doc_id not in long), key=str) == expected
    assert {r.doc_id: tuple(r)[1:5] for r in got if r.doc_id in long} == {
        22: (0, None, None, None), 23: (0, None, None, None), 24: (1, 0, 5000, 1), 41: (1, 0, 3000, 1)
    }
    found = {r.doc_id: r for r in periodic_runs.found_runs(docs).where("doc_id > 31").collect()}
    assert [tuple(r) for r in found[32].runs] == [(0, 6, 1)] and found[32].collapsed == "a"
    assert found[33].runs == [] and found[33].n_words == 5
    assert periodic_runs.found_runs(cases.frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.found_runs(docs, power=1)


def test_registered_runs_equal_all_periods(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, SF).collect()))
    # a run needs a repeated pair of neighbours; texts without one have none, which keeps the plain version short
    short = {r.doc_id for r in docs if len(cases.words(r.text)) < 700}
    expected = sorted(plain_digest(r.doc_id, r.text, edit=True) for r in docs if r.doc_id in short)
    assert [g for g in got if g[0] in short] == expected and len(got) == len(docs)
    assert len(short) > 0.8 * len(docs) and sum(g[1] for g in got) > 5


def test_planted_words():
    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    words = [str(k).encode() for k in range(100)]
    changed = planted(words, doc_id)
    assert changed != words and len(changed) == 100 and planted([], doc_id) == []
    assert planted(words, None) is words and planted(words, doc_id)[0] == words[0]


# --- Ranked lexical search ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, queries, k=10):
    held = [(i, terms_of(t)) for i, t in docs]
    n_docs, n_terms = sum(1 for _, t in held if t), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in queries:
        scored = []
        for i, t in held:
            score = 0
            for x in set(terms_of(text)) & set(t):
                weight, m = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))), 10 + 90 * len(t) * n_docs // n_terms
                score += weight * (1_000_000_000 * t.count(x) // (1000 * t.count(x) + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def searched(spark, docs, queries, k=10):
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(queries, "item_id long, text string")
    return sorted(map(tuple, lexical_search.best_documents(rows, asked, k).collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"DOCUMENTS": 7, "BLOCK": 2, "STEP": 1}, {"INDEX_TERMS": 3, "CELLS": 40, "BLOCK": 3}, {"PASS_TERMS": 4}])
def test_ranks_equal_all_scores(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(40)]
    docs = [(k, " ".join(rng.choices(vocabulary, [1 / (1 + j) for j in range(40)], k=rng.randrange(0, 40)))) for k in range(120)]
    docs += [(200 + k, docs[k][1]) for k in range(30)]  # ties
    queries = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 12)))) for k in range(9)]
    expected = plain_search(docs, queries, k=4)
    assert searched(spark, docs, queries, k=4) == sorted(expected, key=str)


def test_search_over_hard_rows(spark):
    texts = [*cases.TEXTS, "Größe größe GRÖSSE", "don't DON'T", "a-b_c.d", "x" * 300, "the the the word", "word", "word"]
    docs = [(k, t) for k, t in enumerate(texts)] + [(None, "word"), (3, "word line"), (3, "word line")]
    queries = [(1, "word"), (2, None), (3, "?!"), (4, "absent"), (5, "größe don t é 日本語"), (6, "line LINE one"), (6, "two"), (None, "word")]
    assert searched(spark, docs, queries) == sorted(plain_search(docs, queries), key=str)
    assert searched(spark, [], queries) == [] and searched(spark, docs, []) == []
    assert searched(spark, [(1, None), (2, "")], queries) == []


def test_bounds_are_not_below_scores():
    rng = np.random.default_rng(5)
    doc, column = np.nonzero(rng.random((300, 30)) < 0.3)
    value = rng.integers(1, 1 << 34, len(doc))
    index = lexical_search.Index(doc, column, value, 300, 30)
    for c in range(30):
        listed = [index.docs[index.ends[b] : index.ends[b + 1]] for b in range(index.lists[c], index.lists[c + 1])]
        assert sorted(np.concatenate(listed).tolist()) == sorted(doc[column == c].tolist())
        for b, own in zip(range(index.lists[c], index.lists[c + 1]), listed, strict=True):
            assert (index.most[b] >= index.values[own]).all()


def test_search_skips_blocks(monkeypatch):
    """Documents of a few kinds: blocks of other kinds than the query's are not scored."""
    rng = np.random.default_rng(6)
    kinds = rng.integers(0, 8, 4000)
    parts = [(np.repeat(k, 6), np.append(kind * 10 + rng.choice(9, 5, replace=False), 80)) for k, kind in enumerate(kinds)]
    doc, column = (np.concatenate(x) for x in zip(*parts, strict=True))
    value = np.where(column == 80, 5, rng.integers(900, 1000, len(doc)))
    index = lexical_search.Index(doc, column, value, 4000, 81)
    looked = []
    plain = np.ix_
    monkeypatch.setattr(lexical_search.np, "ix_", lambda own, columns: looked.append(len(own)) or plain(own, columns))
    scores, names = index.search(np.array([0, 1, 2, 3, 80]), np.arange(4000), 10, None)
    exact = index.values[:, [0, 1, 2, 3, 80]].sum(1)
    assert scores.tolist() == np.sort(exact)[::-1][:10].astype(int).tolist()
    assert sum(looked) < 0.5 * 4000  # a common term is in all of them


def test_registered_search_equals_its_sql(spark):
    rows = same_as_sql(spark, "op13_lexical_search")
    assert max(r[1] for r in rows) == 10
