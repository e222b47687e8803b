"""Token files, packing, byte-level BPE and fingerprints."""

import base64
import hashlib
import random
import zlib

import cases
import numpy as np
import pytest
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from visitflow.llm import byte_bpe, fingerprints, id_files, packing, tokens
from visitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_words_give_the_ids_of_whole_texts(library, monkeypatch):
    monkeypatch.setattr(tokens, "RECENT", 20)
    monkeypatch.setattr(tokens, "REMEMBERED", 60)
    odd = [
        "", " ", "á ́b", "x\x85y \xa0 z", "　a b c", "don't I'LL 's 's", "ΑΣ Σ ΑΣΑΣ", "İstanbul ǅ",
        "\x1c a\x1cb\x1f", "<|endoftext|>", "각 가", "1234 ½ ²³", "​‍", "👍🏽🇩🇪", "a" * 300 + " b",
        "\x00", "a \x01 b\x01c", "H̱ ẖ straße,Größe-12é ÷× ß' Ÿ", "a<|ENDOFTEXT|>b x", *[t or "" for t in cases.TEXTS],
    ]
    encode = tokens.Encoder(open(PATH, "rb").read())
    for _ in range(2):
        for text, got in zip(odd, encode.many([t.encode() for t in odd]), strict=True):
            assert got.tolist() == library.encode(text, add_special_tokens=False).ids


SPECIAL = [
    "x <|endoftext|> y", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext| >", "don't<|endoftext|>é",
    "<|endoftext|>\u0338 <|endoftext|>\u0301e", f"{'a' * 300}<|startoftext|>{'b' * 300}", "\x01<|endoftext|>\x01",
]


def test_added_tokens_are_found_as_the_library_finds_them(spark, tmp_path):
    default = Tokenizer.from_file(PATH)
    expected = [default.encode(t, add_special_tokens=False).ids for t in SPECIAL]
    assert expected[0] == [343, 49407, 344]
    encode = tokens.encoder(open(PATH, "rb").read())
    for _ in range(2):
        assert [x.tolist() for x in encode.many([t.encode() for t in SPECIAL])] == expected
    data = cases.rows(SPECIAL, range(len(SPECIAL)))
    cases.frame(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, QUERIES["op5_token_files"](spark, str(tmp_path)).collect()))
    assert [(n, check) for _, _, n, check in got] == [(len(ids) + 1, crc([*ids, 2])) for ids in expected]
    texts = {r[0]: r[1] for r in data}
    check_pieces(QUERIES["op8_packing"](spark, str(tmp_path)).collect(), texts, default)
    check_pieces(dict(corpus_pipeline.STAGES)["packing"](spark, cases.frame(spark, data), "").collect(), texts, default)


@pytest.mark.parametrize("wide", [False, True])
def test_codes_round_trip(wide):
    rng = np.random.default_rng(0)
    codes = id_files.Codes(wide)
    top = 1 << 32 if wide else 1 << 16
    docs = [rng.integers(0, top >> rng.integers(0, 15), n).astype(np.uint32) for n in (0, 1, 7, 8, 9, 3, 4, 5, 1000)]
    docs.append(np.array([0, 255, 256, top - 1], np.uint32))
    both = [codes.encode(d) for d in docs]
    lengths = np.array([len(d) for d in docs])
    got = codes.decode(b"".join(c for c, _ in both), b"".join(d for _, d in both), lengths)
    assert np.array_equal(got, np.concatenate(docs))
    assert [len(c) for c, _ in both] == codes.control_bytes(lengths).tolist()


def file_rows(spark, data, folder):
    docs = cases.with_clashes(cases.frame(spark, data))
    id_files.write(docs, PATH, str(folder))
    return sorted(map(tuple, id_files.read(spark, str(folder)).collect()), key=lambda r: r[1])


def test_files_hold_every_document_in_order(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(id_files, "BLOCK_IDS", 300)
    ids = list(range(len(cases.TEXTS)))
    random.Random(1).shuffle(ids)
    data = cases.rows(cases.TEXTS, ids) + cases.rows(["first", None], [None, None]) + cases.rows(["twice"] * 2, [5, 5])
    got = file_rows(spark, data, tmp_path / "corpus")
    assert [r[0] for r in got] == sorted((r[0] for r in data), key=lambda i: -1 if i is None else i)
    start = 0
    expected = {(r[0], ids_of(library, r[1]).tobytes()) for r in data}
    for doc_id, at, n, check, raw in got:
        assert (at, n, check) == (start, len(raw) // 4, zlib.crc32(raw)) and (doc_id, bytes(raw)) in expected
        start += n
    # Ids that are more frequent in the corpus have lower ranks.
    ranks = {r.id: r.rank for r in spark.read.parquet(f"{tmp_path}/corpus/vocabulary").collect()}
    every, counts = np.unique(np.concatenate([np.frombuffer(r[4], "<u4") for r in got]), return_counts=True)
    order = sorted(zip(every.tolist(), counts.tolist(), strict=True), key=lambda x: (-x[1], x[0]))
    assert [ranks[i] for i, _ in order] == list(range(len(order)))


def test_empty_table_gives_empty_files(spark, tmp_path):
    assert file_rows(spark, [], tmp_path / "none") == []
    docs = cases.frame(spark, [])
    assert packing.packed(docs, PATH).collect() == []
    assert byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect() == []
    assert fingerprints.compared_with_edits(docs).collect() == []


def test_registered_files_equal_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = sorted(map(tuple, QUERIES["op5_token_files"](spark, SF).collect()))
    start, expected = 0, []
    for r in rows:
        ids = ids_of(library, r.text)
        expected.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == expected


# --- Packing --------------------------------------------------------------------------------------


def check_pieces(pieces, texts, library, capacity=4096):
    """texts: doc_id to text. Every id in one piece, sequences without gap or padding."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        ids, at = ids_of(library, texts[doc_id]), 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == crc(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity and at & (at - 1) == 0 and {p.sequence_tokens for p in own} == {at}


@pytest.mark.parametrize("together", [1 << 22, 5000])
def test_pieces(spark, library, monkeypatch, together):
    monkeypatch.setattr(packing, "TOGETHER", together)
    docs = cases.with_clashes(cases.frame(spark, cases.rows()).coalesce(2))
    pieces = packing.packed(docs, PATH).collect()
    check_pieces(pieces, dict(zip(range(10, 10 + len(cases.TEXTS)), cases.TEXTS, strict=True)), library)


def test_rows_without_or_with_the_same_id_are_packed(spark):
    data = cases.rows(["a b c", "a b c", None, "d"], [None, None, 3, 3])
    pieces = packing.packed(cases.frame(spark, data), PATH).collect()
    assert sum(p.length for p in pieces) == 4 + 4 + 1 + 2


def test_items_go_to_the_cheapest_sequence_with_room():
    placed = list(packing.placed(np.array([6, 5, 5, 4, 4, 8, 19]), 8, 1.0, 1.0))
    used: dict = {}
    for _, _, length, sequence, offset in placed:
        assert offset == used.get(sequence, 0)
        used[sequence] = offset + length
    assert sorted(used.values()) == [1, 2, *[8] * 6]
    # Whole sequences first, then the longest rests, each to an empty and so cheapest sequence.
    assert [p[:3] for p in placed[:6]] == [(5, 0, 8), (6, 0, 8), (6, 8, 8), (0, 0, 6), (1, 0, 5), (2, 0, 5)]
    assert len({p[3] for p in placed[:6]}) == 6


def test_costs_are_balanced():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 700, 2000)
    cost: dict = {}
    for _, _, length, sequence, _ in packing.placed(sizes, 4096, 1.0, 1 / 1024):
        cost[sequence] = cost.get(sequence, 0) + length + length * length / 1024
    full = sorted(cost.values())[-(int(sizes.sum()) // 4096) :]
    assert max(full) / np.mean(full) < 1.05


def test_registered_packing(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check_pieces(QUERIES["op8_packing"](spark, SF).collect(), {r.doc_id: r.text for r in rows}, library)


# --- Byte-level BPE -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    lines = open(RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_matrix_rounds_equal_the_library(reference, monkeypatch):
    codec = byte_bpe.Codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    rng = random.Random(2)
    texts = [t or "" for t in cases.TEXTS] + [
        "  a  b \n\n c\t\t d", "don't I'LL we've ' s", "1234½²", "\x1c a\x1cb\x1f\x85\xa0 x  　y", "a" * 3000, "ab" * 4000,
        "!?" * 5000, " " * 3000 + "x", "".join(rng.choice("abcde fgé日\n") for _ in range(20_000)),
        "".join(rng.choice("abcdefgh") for _ in range(9000)), "<|endoftext|>",
        *["".join(rng.choice("aeinrst '\n") for _ in range(rng.randrange(60))) for _ in range(500)],
    ]
    for cache in (300_000, 10):
        monkeypatch.setattr(byte_bpe, "CACHE_WORDS", cache)
        for text, got in zip(texts, codec.encode(texts), strict=True):
            assert got.tolist() == reference.encode_ordinary(text)
            assert codec.decode(got) == text.encode()


def test_round_trip_of_hard_rows(spark, reference):
    data = cases.rows() + cases.rows(["no id", "twice", "twice"], [None, 3, 3])
    out = byte_bpe.round_trip(cases.with_clashes(cases.frame(spark, data)), RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for r in data:
        ids = reference.encode_ordinary(r[1] or "")
        expected.append((r[0], len(ids), ",".join(map(str, ids)), (r[1] or "").encode()))
    got = [(r.doc_id, r.n_tokens, r.ids_text.decode(), bytes(r.decoded)) for r in out]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_registered_bpe_equals_the_library(spark, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op9_byte_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- Fingerprints ---------------------------------------------------------------------------------


def phrases(text):
    """The Lempel-Ziv phrases of a text, by slicing."""
    found, begin, raw = set(), 0, text.encode()
    for end in range(1, len(raw) + 1):
        if raw[begin:end] not in found:
            found.add(raw[begin:end])
            begin = end
    return found


def test_likeness_estimates_the_likeness_of_phrase_sets():
    texts = [t or "" for t in cases.TEXTS] + [cases.passage(4, 300) + cases.passage(k, 100) for k in range(60, 70)]
    codes = [fingerprints.Parse().add(t.encode()).codes() for t in texts]
    for a in range(len(texts)):
        for b in range(a):
            p, q = phrases(texts[a]), phrases(texts[b])
            exact = len(p & q) / len(p | q) if p | q else 1.0
            assert abs(fingerprints.likeness(codes[a], codes[b]) - exact) < 0.25
    assert fingerprints.fingerprint("") == "ffff" * fingerprints.BINS
    assert fingerprints.likeness(codes[0], codes[1]) == 1.0


def test_a_fork_goes_on_from_where_it_was():
    for text in (t or "" for t in cases.TEXTS):
        cut = len(text) // 3
        start = fingerprints.Parse().add(text[:cut].encode())
        forked = start.fork().add(text[cut:].encode())
        assert fingerprints.as_text(forked.codes()) == fingerprints.fingerprint(text)
        assert fingerprints.as_text(start.codes()) == fingerprints.fingerprint(text[:cut])


def expected_edits(data):
    """Rows for documents in order of doc_id, then text."""
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, r in enumerate(ordered):
        text, following = r[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        codes = [fingerprints.Parse().add(t.encode()).codes() for t in (text, edited, following)]
        out.append(
            (r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.as_text(codes[0]),
             fingerprints.as_text(codes[1]), fingerprints.likeness(codes[0], codes[1]),
             fingerprints.likeness(codes[0], codes[2]))
        )
    return sorted(out, key=str)


def test_edits_across_ranges(spark):
    ids = list(range(len(cases.TEXTS)))
    random.Random(4).shuffle(ids)
    data = cases.rows(cases.TEXTS, ids) + cases.rows(["no id here", "twice it is", "twice it is"], [None, 3, 3])
    docs = cases.with_clashes(cases.frame(spark, data))
    got = sorted(map(tuple, fingerprints.compared_with_edits(docs).collect()), key=str)
    assert got == expected_edits(data)


def test_one_document_follows_itself(spark):
    data = cases.rows([cases.passage(1, 40)], [7])
    assert [tuple(r) for r in fingerprints.compared_with_edits(cases.frame(spark, data)).collect()] == expected_edits(data)


def test_registered_fingerprints(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op10_fingerprints"](spark, SF).collect()), key=str)
    assert got == expected_edits(data)
