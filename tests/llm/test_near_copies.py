"""N-gram Jaccard join and substring removal against all pairs and all windows."""

import hashlib
import random

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from visitflow.llm import ngram_join, shared, substring_dedup
from visitflow.llm.hashing import Words, bytes_of, span_hashes
from visitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def found_groups(docs, **options):
    out = ngram_join.similar_groups(docs, **options)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return [tuple(r) for r in out.collect()]


def edited(rng, base, share):
    w = base.split()
    for k in range(len(w)):
        if rng.random() < share:
            w[k] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 50), (3, 100)])
def test_components_equal_all_pairs(spark, width, percent):
    rng = random.Random(width)
    bases = [cases.passage(100 + k, n) for k, n in enumerate((4, 12, 40, 150, 150, 600))]
    texts = list(cases.TEXTS)
    for _ in range(150):
        texts.append(edited(rng, rng.choice(bases), rng.choice([0, 0.003, 0.01, 0.02, 0.05])))
    data = cases.rows(texts)
    got = found_groups(cases.frame(spark, data), width=width, percent=percent)
    assert {r[0]: r[1:] for r in got} == cases.groups(data, width, percent)


def test_many_blocks_and_slices_change_nothing(spark, monkeypatch):
    """A group of near copies over many blocks, some linked and some only alike."""
    rng = random.Random(5)
    base = cases.passage(50, 120)
    data = cases.rows([edited(rng, base, rng.choice([0.005, 0.02, 0.04])) for _ in range(120)])
    docs = cases.frame(spark, data)
    plain = found_groups(docs, width=3, percent=90)
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 3000)
    cut = found_groups(docs, width=3, percent=90)
    assert sorted(plain) == sorted(cut)
    assert {r[0]: r[1:] for r in cut} == cases.groups(data, 3, 90)


def overlapping(n, step, size):
    """Texts of which each is alike to its next neighbours only, in an order of ids that scatters them."""
    every = cases.passage(77, step * n + size).split()
    ids = list(range(n))
    random.Random(4).shuffle(ids)
    return cases.rows([" ".join(every[k * step : k * step + size]) for k in range(n)], ids)


@pytest.mark.parametrize("few", [None, 1])
def test_documents_go_to_blocks_that_they_can_link_with(spark, monkeypatch, few):
    """A cluster over 30 blocks in which a document is alike to few others; with one block followed, blocks meet whole."""
    sent, paired = [], ngram_join._paired

    def counted(*tables):
        sent.append(paired(*tables))
        return sent[-1]

    monkeypatch.setattr(ngram_join, "_paired", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 3000)
    monkeypatch.setattr(shared, "discard", lambda frame: None)
    if few:
        monkeypatch.setattr(ngram_join, "FEW_BLOCKS", few)
    data = overlapping(120, 7, 150)
    got = found_groups(cases.frame(spark, data), width=3, percent=90)
    assert {r[0]: r[1:] for r in got} == cases.groups(data, 3, 90) and {r[2] for r in got} == {0}
    assert sent[0].where("p = q").count() == 120
    if not few:
        assert sent[0].where("p < q").count() < 120 * 9


def sent_across(monkeypatch):
    """Rows that go to a pair of unlike blocks, counted when the function it gives is called; blocks are small."""
    sent, paired = [], ngram_join._paired

    def counted(*tables):
        sent.append(paired(*tables))
        return sent[-1]

    monkeypatch.setattr(ngram_join, "_paired", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 3000)
    monkeypatch.setattr(shared, "discard", lambda frame: None)
    return lambda: sum(frame.where("p < q").count() for frame in sent)


@pytest.mark.parametrize("kind", ["copies of one text", "texts with a common passage"])
def test_rows_sent_do_not_grow_with_the_square_of_a_cluster(spark, monkeypatch, kind):
    """Over about 30 blocks, which documents once met one by one; a row for each and block would be over 2000."""
    rng = random.Random(11)
    if kind == "copies of one text":
        base = cases.passage(60, 130)
        words = [base.split() for _ in range(140)]
        for k, w in enumerate(words):
            w[rng.randrange(130)] = f"new{k}"
        data = cases.rows([" ".join(w) for w in words])
    else:
        common = cases.passage(61, 130)
        data = cases.rows([common + " " + cases.passage(2000 + k, 22) for k in range(140)])
    rows = sent_across(monkeypatch)
    got = found_groups(cases.frame(spark, data), width=3, percent=90)
    expected = cases.groups(data, 3, 90)
    assert {r[0]: r[1:] for r in got} == expected
    assert len({c for _, c in expected.values()}) == (1 if kind == "copies of one text" else 140)
    assert rows() <= 2 * 140


@pytest.mark.parametrize("kind", ["copies of one text", "texts with a common passage"])
def test_rows_joined_by_shingles_do_not_grow_with_the_square_of_a_cluster(spark, monkeypatch, kind):
    """Over 7 blocks of 20 documents, a shingle that all have is one row a block; groups that have it are not met one by one."""
    base, rng = cases.passage(64, 130), random.Random(13)
    if kind == "copies of one text":
        words = [base.split() for _ in range(140)]
        for k, w in enumerate(words):
            w[rng.randrange(130)] = f"new{k}"
        data = cases.rows([" ".join(w) for w in words])
    else:  # alike by less than a link takes: each stays alone
        data = cases.rows([base + " " + cases.passage(3000 + k, 10) for k in range(140)])
    joined, join = [], DataFrame.join

    def counted(one, other, on=None, how=None):
        out = join(one, other, on, how)
        if isinstance(on, str) and on == "gram":
            joined.append(out)
        return out

    monkeypatch.setattr(DataFrame, "join", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 13_000)
    monkeypatch.setattr(shared, "discard", lambda frame: None)
    got = found_groups(cases.frame(spark, data), width=3, percent=90)
    expected = cases.groups(data, 3, 90)
    assert {r[0]: r[1:] for r in got} == expected
    assert len({c for _, c in expected.values()}) == (1 if kind == "copies of one text" else 140)
    rows = [frame.count() for frame in joined]
    assert rows and max(rows) < sum(n for n, _ in expected.values()) / 2


def test_common_passages_far_from_a_link_make_no_clusters(spark, monkeypatch):
    """Texts that have three fifths from a few passages come together in one cluster no more; pairs that link stay."""
    rng = random.Random(17)
    commons = [cases.passage(70 + k, 30) for k in range(5)]
    texts = [" ".join([*rng.sample(commons, 2), cases.passage(5000 + k, 40)]) for k in range(300)]
    texts += [edited(rng, t, 0.005) + " more" for t in texts[:20]]
    data = cases.rows(texts)
    seen, stored = {}, shared.stored

    def counted(df, label):
        out = stored(df, label)
        seen.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(shared, "stored", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 3000)
    got = found_groups(cases.frame(spark, data), width=5, percent=80)
    expected = cases.groups(data, 5, 80)
    assert {r[0]: r[1:] for r in got} == expected
    assert 300 <= len({c for _, c in expected.values()}) < 320
    assert seen["sets"][0] <= 60 and seen["counted"][0] <= 60 * 100


@pytest.mark.parametrize("most", [1 << 16, 3])
def test_without_common_rows_linked_sets_share_one(monkeypatch, most):
    """Pairs that share as many rows as a link takes still share one, with groups of any size."""
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "WIDE_GROUP", most)
    rng = np.random.default_rng(8)
    rows = sorted({(int(s * s // 300), int(d)) for s, d in zip(rng.integers(0, 300, 2000), rng.integers(0, 100, 2000), strict=True)})
    columns = {"sig": pa.int64(), "doc_id": pa.int64(), "tag": pa.int32()}
    table = pa.table({c: pa.array([(s, d, 256 + 1 + d % 4)[k] for s, d in rows], t) for k, (c, t) in enumerate(columns.items())})
    met = pa.Table.from_batches(list(ngram_join._met(table.to_batches(max_chunksize=7)))).sort_by([("doc_id", "ascending"), ("tag", "ascending")])
    of, left = {}, {}
    for s, d in rows:
        of.setdefault(d, set()).add(s)
    for batch in ngram_join._without_common(ngram_join._sharing(met.to_batches(max_chunksize=11), "many")):
        for r in batch.to_pylist():
            left.setdefault(r["doc_id"], set()).add(r["sig"])
    linked = [(a, b) for a in of for b in of if a < b and len(of[a] & of[b]) >= 1 + max(a % 4, b % 4)]
    assert len(linked) > 100 and all(left[a] & left[b] for a, b in linked)
    assert sum(map(len, left.values())) < len(rows)


@pytest.mark.parametrize("few", [1, 1000])
def test_clusters_over_many_blocks_equal_all_pairs(spark, monkeypatch, few):
    """Several groups that share passages, with documents just above and below the share of a link, and one id with two texts."""
    rng = random.Random(12)
    bases = [cases.passage(62, 90) + " " + cases.passage(63 + k, 50) for k in range(4)]
    texts = [edited(rng, rng.choice(bases), rng.choice([0.002, 0.01, 0.017, 0.03])) for _ in range(140)]
    data = cases.rows(texts)
    twice = cases.rows([edited(rng, bases[0], 0), edited(rng, bases[1], 0)], [5, 5])
    monkeypatch.setattr(ngram_join, "FEW_BLOCKS", few)
    sent_across(monkeypatch)
    plain = found_groups(cases.frame(spark, data), width=3, percent=90)
    assert {r[0]: r[1:] for r in plain} == cases.groups(data, 3, 90)
    both = dict((r[0], r[2]) for r in found_groups(cases.frame(spark, data + twice), width=3, percent=90))
    one = cases.groups([*data, *cases.rows([twice[0][1]], [5]), *cases.rows([twice[1][1]], [6])], 3, 90)
    joined = {one[5][1], one[6][1]}
    assert {i: c for i, c in both.items()} == {i: 5 if c in joined else c for i, (_, c) in one.items() if i != 6}


@pytest.mark.parametrize("rows_a_batch, most", [(1000, 1 << 16), (7, 1 << 16), (7, 3)])
def test_rows_shared_with_one_party(monkeypatch, rows_a_batch, most):
    """Against counting for each pair: no row that a pair shares often enough goes, whatever the size of a group."""
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "WIDE_GROUP", most)
    rng = np.random.default_rng(3)
    rows = sorted({(int(s), int(d)) for s, d in zip(rng.integers(0, 300, 900), rng.integers(0, 150, 900), strict=True)} | {(5, d) for d in range(40)})

    def batches(columns):
        table = pa.table({k: pa.array(v, t) for k, (v, t) in columns.items()})
        return table.to_batches(max_chunksize=rows_a_batch)

    def listed(out):
        return [x for b in out for x in b.to_pylist()]

    met = listed(ngram_join._met(batches({
        "sig": ([s for s, _ in rows], pa.int64()), "doc_id": ([d for _, d in rows], pa.int64()), "tag": ([256 + 2] * len(rows), pa.int32()),
    })))
    met.sort(key=lambda r: (r["doc_id"], r["tag"]))
    kept = listed(ngram_join._sharing(batches({
        c: ([r[c] for r in met], pa.int32() if c == "tag" else pa.int64()) for c in ("sig", "doc_id", "tag", "others")
    })))
    of = {}
    for s, d in rows:
        of.setdefault(d, set()).add(s)
    needed = {(s, a) for a in of for b in of if a != b and len(of[a] & of[b]) >= 2 for s in of[a] & of[b]}
    got = {(r["sig"], r["doc_id"]) for r in kept}
    assert needed <= got <= set(rows) and len(got) == len(kept)
    if most > 100:
        assert len(got) < 0.8 * len(rows)


@pytest.mark.parametrize("slice_bytes", [64, 4096, 1 << 20])
def test_column_slices_find_the_same_pairs(monkeypatch, slice_bytes):
    monkeypatch.setattr(ngram_join, "SLICE_BYTES", slice_bytes)
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 60, 200).astype(np.uint64))
    values = []
    for _ in range(40):
        own = base[rng.random(len(base)) < rng.choice([0.5, 0.93, 0.97, 1])]
        values.append(np.union1d(own, rng.integers(0, 1 << 60, int(rng.integers(0, 12))).astype(np.uint64)))
    every = np.arange(40)
    i, j = ngram_join.linked_pairs(values, every, every, 80)
    expected = {
        (a, b)
        for a in range(40)
        for b in range(a + 1, 40)
        if 100 * len(np.intersect1d(values[a], values[b])) >= 80 * len(np.union1d(values[a], values[b]))
    }
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == expected
    left, right = every[:15], every[15:]
    i, j = ngram_join.linked_pairs(values, left, right, 80)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, b in expected if a < 15 <= b}


def test_null_and_repeated_ids(spark):
    text = cases.passage(3, 30)
    data = cases.rows([text, text, text, "", None, text], [5, 5, None, 7, 8, 9])
    got = found_groups(cases.with_clashes(cases.frame(spark, data)), width=3, percent=90)
    assert sorted(got, key=str) == sorted(
        [(5, 28, 5), (5, 28, 5), (None, 28, None), (7, 0, 7), (8, 0, 8), (9, 28, 5)], key=str
    )


def test_one_id_with_two_texts_links_both(spark):
    a, b = cases.passage(1, 40), cases.passage(2, 40)
    got = found_groups(cases.frame(spark, cases.rows([a, b, a, b], [1, 2, 3, 3])), width=3, percent=90)
    assert {r[0]: r[2] for r in got} == {1: 1, 2: 1, 3: 1}


def test_empty_table(spark):
    docs = cases.frame(spark, [])
    assert found_groups(docs) == []
    assert substring_dedup.without_repeats(docs).collect() == []


def test_registered_join_equals_all_pairs(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op1_ngram_jaccard_join"](spark, SF).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cases.groups(data, 3, 90) and len(got) == len(data)


def test_components_of_paths_and_stars(spark):
    pairs = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (159, 300)]
    got = shared.components(spark.createDataFrame(pairs, shared.EDGES)).collect()
    roots = {r.node: r.root for r in got}
    assert len(got) == len(roots)
    assert all(roots[k] == 0 for k in range(61)) and all(roots[k] == 100 for k in [*range(100, 160), 300])


# --- Substrings -----------------------------------------------------------------------------------


def removed(docs, **options):
    return [(r["row"]["doc_id"], r.n_words, r.n_removed, r.kept) for r in
            substring_dedup.without_repeats(docs, **options).collect()]


def passages(seed):
    rng = random.Random(seed)
    common = [cases.passage(500 + k, n) for k, n in enumerate((50, 51, 65, 120, 49))]
    texts = list(cases.TEXTS)
    for k in range(60):
        parts = [cases.passage(1000 + 7 * k + i, rng.randrange(1, 60)) for i in range(3)]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(4), rng.choice(common))
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    texts += [texts[-1], texts[-2] + " more", cases.passage(9999, 20) * 3, "same " * 130, "same " * 70]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return cases.rows(texts, ids)


@pytest.mark.parametrize("bucket", [8192, 1])
def test_kept_words_equal_all_windows(spark, monkeypatch, bucket):
    """With a bucket of one string, all windows of shared minimisers travel one by one."""
    monkeypatch.setattr(substring_dedup, "BUCKET", bucket)
    monkeypatch.setattr(substring_dedup, "TOGETHER", 7 if bucket == 8192 else 2000)
    data = passages(3)
    got = removed(cases.frame(spark, data), joined=True)
    expected = cases.kept_words(data)
    assert len(got) == len(data) and sum(r[2] for r in got) > 1000
    for doc_id, n_words, n_removed, kept in got:
        all_words, kept_words = expected[doc_id]
        assert (n_words, n_words - n_removed, kept) == (len(all_words), len(kept_words), " ".join(kept_words))


def test_text_keeps_its_white_space(spark):
    first = cases.passage(5, 60)
    second = f"  start\there\n{first}\n\n tail  end "
    data = cases.rows([first, second, "a  b\n c"], [1, 2, 3])
    kept = {r[0]: r[3] for r in removed(cases.frame(spark, data))}
    assert kept == {1: first, 2: "  start\there\ntail  end ", 3: "a  b\n c"}


def test_rows_without_or_with_the_same_id(spark):
    text = cases.passage(5, 60)
    data = cases.rows([text, text, text, text, None], [4, 4, None, None, 9])
    docs = cases.with_clashes(cases.frame(spark, data))
    got = removed(docs, joined=True)
    assert sorted(((i, n) for i, _, n, _ in got), key=str) == sorted(
        [(4, 0), (4, 0), (None, 60), (None, 60), (9, 0)], key=str
    )
    back = substring_dedup.without_repeats(docs).select("row.*")
    assert back.columns == docs.columns and sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))


def test_registered_removal_equals_all_windows(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = cases.kept_words(data)
    got = QUERIES["op6_substring_dedup"](spark, SF).collect()
    assert len(got) == len(data)
    for r in got:
        every, kept = expected[r.doc_id]
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert tuple(r) == (r.doc_id, len(every), len(every) - len(kept), digest)


# --- Hashes and order -----------------------------------------------------------------------------


def test_word_hashes_do_not_depend_on_windows(monkeypatch):
    import pyarrow as pa

    from visitflow.llm import hashing

    raw, at = bytes_of(pa.array(cases.TEXTS))
    plain = Words(raw, at)
    monkeypatch.setattr(hashing, "WINDOW", 16)
    small = Words(raw, at)
    assert np.array_equal(plain.hashes, small.hashes) and np.array_equal(plain.first, small.first)
    spans = span_hashes(raw, plain.starts, plain.ends)
    assert np.array_equal(spans, plain.hashes)
    for k, text in enumerate(cases.TEXTS):
        own = [raw[s:e].tobytes() for s, e in zip(plain.starts, plain.ends, strict=True)][plain.first[k] : plain.first[k + 1]]
        assert own == (text or "").encode().split()


def test_ranks_and_sums(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 13).alias("k"), "id", (F.col("id") % 5).alias("w"))
    got = shared.with_rank(df, ["k", "id"], "w").orderBy("k", "id").collect()
    before = 0
    for position, r in enumerate(got):
        assert (r.position, r.before) == (position, before)
        before += r.w
