"""The pipeline's stages, each against a plain version over its own input, and their hard rows."""

import re

import cases
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_tokens import check_pieces
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from visitflow.llm import rule_ensemble, secret_scan
from visitflow.llm.queries import ORACLE_SQL, QUERIES, held_out

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def listed(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The rows before the first stage and after each, written and read like a run's."""
    folder = tmp_path_factory.mktemp("stages")
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs[-1], SF).write.parquet(str(folder / str(k)))
        docs.append(spark.read.parquet(str(folder / str(k))))
    return docs


def test_stages_are_registered():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "substring dedup", "secret scans", "packing"]
    queries = entry_point.queries()
    assert queries["pipeline"] is corpus_pipeline.run and set(QUERIES) <= set(queries)
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(ORACLE_SQL) <= set(entry_point.oracle_sql())


def test_all_but_the_last_return_documents(staged):
    for docs in staged[:-1]:
        assert docs.columns == COLUMNS
    for before, after in zip(staged[:-2], staged[1:-1], strict=True):
        ids = {r[0] for r in listed(before)}
        got = [r[0] for r in listed(after)]
        assert set(got) <= ids and len(got) == len(set(got))


def test_quality_stage_keeps_what_the_rules_accept(spark, staged):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = rule_ensemble.scored(staged[0], labels, ~held_out())
    good = {r.doc_id for r in scores.where("score >= 0.5").collect()}
    assert sorted(listed(staged[1])) == sorted(r for r in listed(staged[0]) if r[0] in good)
    assert 0 < len(good) < staged[0].count()


def test_join_stage_keeps_the_first_of_each_group(staged):
    before = listed(staged[1])
    lead = {i for i, (_, top) in cases.groups(before, 5, 80).items() if i == top}
    assert sorted(listed(staged[2])) == sorted(r for r in before if r[0] in lead)
    assert len(lead) < len(before)


def test_substring_stage_cuts_repeated_passages(staged):
    before, after = {r[0]: r for r in listed(staged[2])}, {r[0]: r for r in listed(staged[3])}
    expected = cases.kept_words([r[:2] for r in before.values()])
    for i, (every, kept) in expected.items():
        if every and not kept:
            assert i not in after
        elif len(kept) == len(every):
            assert after[i] == before[i]
        else:
            assert cases.words(after[i][1]) == kept and after[i][4] == len(after[i][1])
            assert after[i][2:4] == before[i][2:4]


def test_secret_stage_masks_confirmed_secrets(staged):
    before, after = {r[0]: r for r in listed(staged[3])}, {r[0]: r for r in listed(staged[4])}
    found = {}
    for r in secret_scan.scan(staged[3]).where("is_secret").collect():
        found.setdefault(r.doc_id, set()).add(r.candidate)
    assert set(before) == set(after)  # planted secrets: test_forest_separates_secrets_and_masks_them
    for i, r in before.items():
        text = r[1]
        for secret in sorted(found.get(i, ()), key=len, reverse=True):
            text = text.replace(secret, secret_scan.MASK)
        assert after[i][:2] == (i, text) and after[i][4] == (len(text) if i in found else r[4])
        assert not re.search(r"AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}", after[i][1])


def test_packing_stage_packs_all(staged, library):
    check_pieces(staged[5].collect(), {r[0]: r[1] for r in listed(staged[4])}, library)


def test_run_returns_the_last_stage(spark, staged):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    run = corpus_pipeline.run(spark, SF)
    whole = run.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d"))
    again = staged[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d"))
    assert set(columns) <= set(run.columns) and sorted(listed(whole)) == sorted(listed(again))


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_hard_rows(spark, stage, library):
    data = cases.rows() + cases.rows(["no id", None, "twice it is", "twice it is"], [None, None, 3, 3])
    docs = cases.with_clashes(cases.frame(spark, data)).withColumn("source", F.lit(None).cast("string"))
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
    if stage == 4:
        assert sum(r.length for r in out.collect()) == sum(
            len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in data
        )
        return
    assert out.columns == docs.columns
    rows = listed(out)
    if stage == 1:
        assert [r[0] for r in rows].count(3) == 1 and [r[0] for r in rows].count(None) == 2
    if stage == 3:
        assert len(rows) == len(data)
    empty = corpus_pipeline.STAGES[stage][1](spark, cases.frame(spark, []), SF)
    assert empty.collect() == []


def test_join_stage_tells_texts_of_one_id_apart(spark):
    """Unlike, alike and equal texts under one doc_id and under none: one of each group of alike texts stays."""
    long = cases.passage(40, 60)
    texts = [
        (1, long), (1, long + " end"), (1, cases.passage(41, 50)), (1, cases.passage(42, 50)), (None, cases.passage(43, 50)),
        (None, cases.passage(43, 50)), (None, long + " more"), (None, cases.passage(44, 50)), (None, None), (None, ""), (2, "few"),
        (2, "few"), (2, None), (3, cases.passage(45, 50)), (4, cases.passage(45, 50) + " x"), (5, cases.passage(42, 50)), (6, ""),
    ]
    docs = cases.frame(spark, cases.rows([t for _, t in texts], [i for i, _ in texts]))
    kept = [(r[0], r[1]) for r in listed(dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, SF))]
    assert set(kept) <= set(texts) and len(kept) == len(set(kept))
    sets = {t: cases.shingle_set(t, 5) for _, t in texts}

    def alike(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= 80 * len(x | y)

    for i, t in set(texts):
        stands = [k for k in kept if alike(k[1], t)]
        assert len(stands) == 1 if sets[t] else (i, t) in kept  # here every group is one of mutual links
    assert {(3, texts[13][1]), (None, texts[4][1]), (2, "few"), (2, None), (6, "")} <= set(kept)
