"""Removal of word passages that an earlier document has, by super-k-mer partitioning.

A window is `size` neighbouring words of one document. A word goes when it lies in a window whose word
sequence also starts in a document with a smaller doc_id. Windows are judged on the input.

1. The minimiser of a window is the smallest hash of its runs of MINIMISER_WORDS words, so equal windows
   have equal minimisers. Neighbouring windows with one minimiser are a super-k-mer: one packed string of
   words, known by a 128-bit digest.
2. Minimisers that one document alone has are dropped. Equal packed strings are grouped (which combines
   before the shuffle): in all but the first document the whole string goes.
3. Where a minimiser has different packed strings, one of each travels to the minimiser's bucket, where
   sorting ranks all windows exactly and finds the smallest doc_id of each.
4. A minimiser with more than BUCKET strings would make one bucket grow with the corpus. Its windows
   travel one by one under their own digests and are grouped, with the same result.

Defined cases: null, empty and short texts keep all words. A row without doc_id comes after all others;
such rows never lose words to each other, nor do rows with the same doc_id. Repeated rows are each returned.
Columns other than doc_id and text are carried along in `row`, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm import shared
from visitflow.llm.hashing import Words, bytes_of, restored, runs, squeezed, text_groups

MINIMISER_WORDS = 8
BUCKET = 8192
#: Super-k-mers that a task ranks together; whole buckets of up to BUCKET are added at a time.
TOGETHER = 2000
_LAST = (1 << 63) - 1


def without_repeats(docs: DataFrame, size: int = 50, joined: bool = False) -> DataFrame:
    """Rows (row, n_words, n_removed, kept): the input row as a struct, counts, and the text that stays.

    With joined, `kept` is the kept words joined by one space; otherwise only the removed words and the
    white space after each removed stretch are cut out, and other texts stay as they are.
    """
    keyed = docs.select(  # the row carries the text; only the first steps read it as a column
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("rank"),
        F.xxhash64("text").alias("twin"),
        "text",
    )
    texts = keyed.select("rank", "twin", "text")
    mers = shared.stored(
        texts.mapInArrow(
            shared.released(_super_mers(size)), "rank long, twin long, at int, n int, mini long, k1 long, k2 long"
        ),
        "mers",
    )
    # stored, so that both sides of the joins below are plain shuffles, which adaptive execution can split
    met = mers.groupBy("mini").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi")).where("lo < hi")
    alike = shared.stored(mers.join(shared.stored(met.select("mini"), "met"), "mini"), "alike")
    packed = ["mini", "k1", "k2"]
    firsts = shared.stored(
        alike.groupBy(*packed).agg(F.min(F.struct("rank", "twin", "at", "n")).alias("first")), "firsts"
    )
    whole = (
        alike.join(firsts.select(*packed, F.col("first.rank").alias("lo")), packed).where("rank > lo")
        .select("rank", "twin", "at", "n")
    )
    variants = firsts.groupBy("mini").agg(F.count("*").alias("variants")).where("variants > 1")
    unlike = firsts.join(shared.stored(variants, "variants"), "mini").select(
        "first.rank", "first.twin", F.struct("first.at", "first.n", "mini", (F.col("variants") > BUCKET).alias("own")).alias("mer")
    )
    of_text = unlike.groupBy("rank", "twin").agg(F.collect_list("mer").alias("mers"))
    unpacked = shared.stored(
        texts.mapInArrow(shared.released(_smaller), "rank long, twin long, text binary").join(of_text, ["rank", "twin"]).mapInArrow(
            shared.released(_unpacked(size)), "rank long, twin long, at int, n int, mini long, k1 long, k2 long, words binary"
        ),
        "unpacked",
    )
    n = shared.parts(docs.sparkSession)
    ranked = (
        unpacked.where("words IS NOT NULL").select("rank", "twin", "at", "mini", "words")
        .repartition(n, "mini").sortWithinPartitions("mini")
        .mapInArrow(shared.released(_ranked(size)), "rank long, twin long, at int, n int")
    )
    single = unpacked.where("words IS NULL")
    least = single.groupBy("k1", "k2").agg(F.min("rank").alias("lo"))
    alone = single.join(least, ["k1", "k2"]).where("rank > lo").select("rank", "twin", "at", "n")
    spans = whole.unionByName(ranked).unionByName(alone).distinct().groupBy("rank", "twin").agg(
        F.collect_list(F.struct("at", "n")).alias("spans")
    )
    kind = docs.schema.simpleString()
    return keyed.join(spans, ["rank", "twin"], "left").select("row", "spans").mapInArrow(
        shared.released(_cut(size, joined)), f"row {kind}, n_words long, n_removed long, kept string"
    )


def _windows_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbouring values."""
    out, reach = values, 1
    while 2 * reach <= width:
        out, reach = np.minimum(out[:-reach], out[reach:]), 2 * reach
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _super_mers(size: int):
    def run(batches):
        for batch in batches:
            raw, at = bytes_of(batch.column("text"))
            rank, twin = batch.column("rank").to_numpy(), batch.column("twin").to_numpy()
            for i, j in text_groups(at):
                part = raw[at[i] : at[j]]
                words = Words(part, at[i : j + 1] - at[i])
                if len(words.hashes) < size:
                    continue
                least = _windows_min(runs(words.hashes, MINIMISER_WORDS), size - MINIMISER_WORDS + 1)
                first = words.first
                counts = np.maximum(np.diff(first) - size + 1, 0)  # windows of each text
                text = np.repeat(np.arange(j - i), counts)
                window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                spot = first[:-1][text] + window
                mini = least[spot]
                begins = np.ones(len(spot), bool)
                begins[1:] = (mini[1:] != mini[:-1]) | (text[1:] != text[:-1])
                begin = np.flatnonzero(begins)
                if not len(begin):
                    continue
                n = np.diff(np.append(begin, len(spot)))
                lengths = words.ends - words.starts + 1
                ahead = np.cumsum(lengths) - lengths  # where a word begins when words are joined by a space
                digests = []
                of = text[begin]
                s, e = spot[begin], spot[begin] + n + size - 2
                cut = np.searchsorted(of, np.arange(j - i + 1))
                for k in np.unique(of).tolist():
                    plain = b" ".join(part[at[i + k] - at[i] : at[i + k + 1] - at[i]].tobytes().split())
                    zero = ahead[first[k]]
                    p = (ahead[s[cut[k] : cut[k + 1]]] - zero).tolist()
                    q = (ahead[e[cut[k] : cut[k + 1]]] + lengths[e[cut[k] : cut[k + 1]]] - 1 - zero).tolist()
                    digests += [hashlib.md5(plain[x:y], usedforsecurity=False).digest() for x, y in zip(p, q, strict=True)]
                pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict(
                    {
                        "rank": pa.array(rank[i:j][of]), "twin": pa.array(twin[i:j][of]),
                        "at": pa.array(window[begin].astype(np.int32)), "n": pa.array(n.astype(np.int32)),
                        "mini": pa.array(mini[begin].view(np.int64)),
                        "k1": pa.array(pair[:, 0].copy()), "k2": pa.array(pair[:, 1].copy()),
                    }
                )

    return run


_UNPACKED = pa.schema(
    [("rank", pa.int64()), ("twin", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("mini", pa.int64()),
     ("k1", pa.int64()), ("k2", pa.int64()), ("words", pa.binary())]
)


def _smaller(batches):
    for batch in batches:
        columns = [batch.column("rank"), batch.column("twin"), squeezed(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(columns, ["rank", "twin", "text"])


def _unpacked(size: int):
    """The packed string of each super-k-mer asked for; its windows' digests where `own` is set."""

    def run(batches):
        for batch in batches:
            texts = restored(batch.column("text"))
            rank, twin, mers = batch.column("rank"), batch.column("twin"), batch.column("mers")
            for k in range(batch.num_rows):
                words = texts[k].as_py().split()
                rows = []
                for mer in mers[k].as_py():
                    at, n = mer["at"], mer["n"]
                    if not mer["own"]:
                        rows.append((at, n, mer["mini"], None, None, b" ".join(words[at : at + n + size - 1])))
                        continue
                    for s in range(at, at + n):
                        d = hashlib.md5(b" ".join(words[s : s + size]), usedforsecurity=False).digest()
                        rows.append((s, 1, mer["mini"], *np.frombuffer(d, np.int64).tolist(), None))
                for lo in range(0, len(rows), 20_000):
                    some = rows[lo : lo + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rank[k].as_py()] * len(some), pa.int64()), pa.array([twin[k].as_py()] * len(some), pa.int64())]
                        + [pa.array([r[c] for r in some], _UNPACKED.field(c + 2).type) for c in range(6)],
                        schema=_UNPACKED,
                    )

    return run


def _ranked(size: int):
    """Windows in a bucket that an earlier document has too. Rows come sorted by bucket."""

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < TOGETHER:
                continue
            mini = held.column("mini").to_numpy()
            last = int(np.searchsorted(mini, mini[-1]))  # the last bucket may go on in the next batch
            for lo, hi in _bucket_ranges(mini[:last]):
                yield _repeated_windows(held.slice(lo, hi - lo), size)
            held = held.slice(last)
        if held is not None:
            for lo, hi in _bucket_ranges(held.column("mini").to_numpy()):
                yield _repeated_windows(held.slice(lo, hi - lo), size)

    return run


def _bucket_ranges(mini: np.ndarray):
    lo = 0
    while lo < len(mini):
        hi = min(len(mini), lo + TOGETHER)
        hi = int(np.searchsorted(mini, mini[hi - 1], "right"))
        yield lo, hi
        lo = hi


def _repeated_windows(table: pa.Table, size: int) -> pa.RecordBatch:
    packed = [x.split() for x in table.column("words").to_pylist()]
    counts = np.array([len(x) for x in packed], np.int64)
    number: dict[bytes, int] = {}
    order = np.fromiter((number.setdefault(w, len(number)) for x in packed for w in x), np.int64, counts.sum())
    reach = 1
    while 2 * reach <= size:  # order[i] ranks the `reach` words from i on
        order, reach = _pair_order(order[:-reach], order[reach:]), 2 * reach
    if reach < size:
        rest = size - reach
        order = _pair_order(order[: len(order) - rest], order[rest:])
    windows = counts - size + 1
    row = np.repeat(np.arange(len(packed)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    kind = order[(np.cumsum(counts) - counts)[row] + offset]
    rank = table.column("rank").to_numpy()
    least = np.full(int(kind.max()) + 1, _LAST)
    np.minimum.at(least, kind, rank[row])
    gone = np.flatnonzero(rank[row] > least[kind])
    begins = np.ones(len(gone), bool)
    begins[1:] = (gone[1:] != gone[:-1] + 1) | (row[gone[1:]] != row[gone[:-1]])
    first = np.flatnonzero(begins)
    spot = gone[first]
    n = np.diff(np.append(first, len(gone)))
    return pa.RecordBatch.from_pydict(
        {
            "rank": pa.array(rank[row[spot]]), "twin": pa.array(table.column("twin").to_numpy()[row[spot]]),
            "at": pa.array((table.column("at").to_numpy()[row[spot]] + offset[spot]).astype(np.int32)),
            "n": pa.array(n.astype(np.int32)),
        }
    )


def _pair_order(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def _cut(size: int, joined: bool):
    def run(batches):
        for batch in batches:
            raw, at = bytes_of(batch.column("row").field("text"))
            spans, kept = batch.column("spans"), []
            n_words, n_removed = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for k in range(batch.num_rows):
                text = raw[at[k] : at[k + 1]].tobytes()
                words = text.split()
                n_words[k] = len(words)
                own = spans[k].as_py()
                if own:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [s["at"] for s in own], 1)
                    np.add.at(change, [s["at"] + s["n"] + size - 1 for s in own], -1)
                    gone = np.cumsum(change[:-1]) > 0
                    n_removed[k] = gone.sum()
                    if joined:
                        words = [words[x] for x in np.flatnonzero(~gone).tolist()]
                    else:
                        text = _without(text, gone)
                kept.append(b" ".join(words) if joined else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_words), pa.array(n_removed), pa.array(kept, pa.binary()).cast(pa.string())],
                ["row", "n_words", "n_removed", "kept"],
            )

    return run


def _without(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the words marked gone, nor the white space up to the next word that stays."""
    raw = np.frombuffer(text, np.uint8)
    starts = Words(raw, np.array([0, len(raw)])).starts
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    bounds = np.append(starts, len(raw))[edges]
    out, last = [], 0
    for s, e in bounds.reshape(-1, 2).tolist():
        out.append(text[last:s])
        last = e
    return b"".join([*out, text[last:]])


#: For DuckDB: every window of 50 words of every document, and the smallest doc_id that each starts in.
ORACLE_SQL = r"""
WITH split AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM split WHERE len(words) >= 50)
), firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN firsts USING (w) WHERE first < doc_id
), placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT split.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(kept.n, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept ON kept.doc_id = split.doc_id
"""
