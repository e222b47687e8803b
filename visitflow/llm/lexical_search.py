"""Ranked lexical search with exact skipping of geometrically clustered posting blocks.

Terms are runs of ASCII letters, digits and non-ASCII characters, with A to Z lower-cased. A document's score for a
query is the sum of its impacts over the query's terms; an impact is the term's weight times a saturated frequency
in the document (see `impacts`). Each query gets its k best documents, exactly.

1. Queries are taken in blocks of bounded terms, so what a task is sent is bounded. For each block one pass over the
   whole texts stores every document's length and its frequencies of the block's terms: the forward index. Lengths
   and document frequencies are summed over all of it.
2. A task reads its documents a few thousand at a time. The posting list of each term is clustered: some of its
   documents are pivots, and each document joins the pivot that is nearest in a random projection of the impacts.
   A block keeps the coordinatewise maximum of its documents' impacts.
3. A document counts in the list of the rarest term that it shares with the query, so a block's bound for a query
   adds up the maxima of this and of the commoner terms only. Blocks are taken by falling bound and scored exactly,
   until no bound reaches the k-th best score that the task has. A block whose bound equals it is still scored,
   as ties go to the smaller doc_id.
4. The k best of each task are merged, a part of the tasks at a time.

Defined cases: a null text, or one without terms, has no score and does not count as a document. A query without terms,
or whose terms no document has, gives no rows. Documents without doc_id come last among equal scores; rows that repeat
a doc_id, and rows that repeat an item_id, are each ranked. Other columns are not read. Terms are compared by
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm import shared
from visitflow.llm.hashing import Words, bytes_of, text_groups

#: Distinct terms (but for one query more) that are looked for in one pass, and that one index in a task has.
PASS_TERMS = 1 << 17
INDEX_TERMS = 4096
#: Cells of the matrix of documents by terms that a task indexes at a time, and the most documents of it.
CELLS, DOCUMENTS = 1 << 23, 4096
#: Documents of a block on average; blocks that are scored together; dimensions of the projection.
BLOCK, STEP, PLANE = 48, 8, 16
_LAST = (1 << 63) - 1

_table = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or bytes([c]).isalnum() else 32 for c in range(256)
)


def best_documents(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Rows (item_id, rank, doc_id, score) of the k best documents for each row (item_id, text) of queries."""
    spark = docs.sparkSession
    asked = queries.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        _asked, "item_id long, n long, terms binary"
    )
    asked = shared.stored(
        shared.with_rank(asked.where("n > 0"), ["item_id", "terms"], "n").withColumn("pass", F.expr(f"before div {PASS_TERMS}")),
        "asked",
    )
    found = [
        _searched(docs, [(r.position, np.frombuffer(r.terms, np.uint64)) for r in asked.where(F.col("pass") == p).collect()], k)
        for p in range((asked.agg(F.max("pass")).first()[0] or 0) + 1)
    ]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = [F.col("score").desc(), F.asc_nulls_last("doc_id")]
    for keys in (["position", "part"], ["position"]):
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("rank", ranked).where(F.col("rank") <= k)
    names = asked.select("position", "item_id")
    return rows.join(names, "position").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _hashed(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """The terms of neighbouring texts, as words of the texts with everything else made white space."""
    raw, at = bytes_of(column)
    for i, j in text_groups(at):
        plain = raw[at[i] : at[j]].tobytes().translate(_table)
        yield i, j, Words(np.frombuffer(plain, np.uint8), at[i : j + 1] - at[i])


def _asked(batches):
    for batch in batches:
        for i, j, words in _hashed(batch.column("text")):
            terms = [np.unique(words.hashes[s:e]) for s, e in zip(words.first[:-1], words.first[1:], strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "item_id": batch.column("item_id").slice(i, j - i), "n": pa.array([len(t) for t in terms], pa.int64()),
                    "terms": pa.array([t.tobytes() for t in terms], pa.binary()),
                }
            )


def _searched(docs: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """Rows (position, part, doc_id, score): the k best of each task for the queries (position, term hashes)."""
    spark = docs.sparkSession
    terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *[t for _, t in queries]]))
    sent = spark.sparkContext.broadcast(terms)  # PASS_TERMS at most, but for one query
    forward = shared.stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _frequencies(sent), "doc_id long, n long, terms binary, counts binary"
        ),
        "forward",
    )
    n_docs, n_terms = forward.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = forward.select("terms").mapInArrow(_holders(len(terms)), "term int, df long").groupBy("term").agg(F.sum("df"))
    df = np.zeros(len(terms), np.int64)
    for term, count in held.collect():  # one row for each term of the pass, at most
        df[term] = count
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for c in df.tolist()], np.int64)
    plans = spark.sparkContext.broadcast((df, weights, _plans(queries, terms, df)))
    return forward.where("length(terms) > 0").mapInArrow(
        _ranked(plans, n_docs, n_terms, k), "position long, part int, doc_id long, score long"
    )


def _plans(queries, terms, df) -> list[tuple[np.ndarray, list[tuple[int, np.ndarray]]]]:
    """Queries by index: the terms of each index (sorted), and each query's columns in it, rarest term first."""
    out, some, held = [], [], np.zeros(0, np.int64)

    def close():
        columns = [(p, np.searchsorted(held, own)) for p, own in some]
        out.append((held, [(p, c[np.lexsort((c, df[held[c]]))]) for p, c in columns]))

    for position, own in queries:
        own = np.searchsorted(terms, own)
        both = np.union1d(held, own)
        if some and len(both) > INDEX_TERMS:
            close()
            some, both = [], own
        some.append((position, own))
        held = both
    if some:
        close()
    return out


def _frequencies(sent):
    def run(batches):
        terms = sent.value
        for batch in batches:
            for i, j, words in _hashed(batch.column("text")):
                if len(terms):
                    at = np.minimum(np.searchsorted(terms, words.hashes), len(terms) - 1)
                    hit = np.flatnonzero(terms[at] == words.hashes)
                else:
                    at = hit = np.zeros(0, np.int64)
                sizes = np.diff(words.first)
                doc = np.repeat(np.arange(j - i), sizes)[hit]
                pair, count = np.unique(doc * max(1, len(terms)) + at[hit], return_counts=True)
                ends = 4 * np.append(0, np.cumsum(np.bincount(pair // max(1, len(terms)), minlength=j - i)))
                which = (pair % max(1, len(terms))).astype("<i4").tobytes()
                count = count.astype("<i4").tobytes()
                cuts = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(i, j - i), "n": pa.array(sizes.astype(np.int64)),
                        "terms": pa.array([which[s:e] for s, e in cuts], pa.binary()),
                        "counts": pa.array([count[s:e] for s, e in cuts], pa.binary()),
                    }
                )

    return run


def _holders(size: int):
    def run(batches):
        seen = np.zeros(size, np.int64)
        for batch in batches:
            seen += np.bincount(bytes_of(batch.column("terms"))[0].view("<i4"), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at.astype(np.int32)), "df": pa.array(seen[at])})

    return run


def impacts(weight: np.ndarray, count: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """weight * saturated frequency, in whole numbers; n is the length of the document."""
    m = 10 + 90 * n * n_docs // n_terms
    return weight * (1_000_000_000 * count // (1000 * count + 8 * m))


def _ranked(plans, n_docs: int, n_terms: int, k: int):
    def run(batches):
        df, weights, indexes = plans.value
        most = min([DOCUMENTS, *[max(1, CELLS // max(1, len(held))) for held, _ in indexes]])
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                some = batch.slice(lo, most)
                raw, at = bytes_of(some.column("terms"))
                term, count = raw.view("<i4").astype(np.int64), bytes_of(some.column("counts"))[0].view("<i4").astype(np.int64)
                doc = np.repeat(np.arange(some.num_rows), np.diff(at) // 4)
                value = impacts(weights[term], count, some.column("n").to_numpy()[doc], n_docs, n_terms)
                names = some.column("doc_id").fill_null(_LAST).to_numpy()
                for held, queries in indexes:
                    place = np.minimum(np.searchsorted(held, term), len(held) - 1)
                    own = np.flatnonzero((held[place] == term) & (value > 0))
                    index = Index(doc[own], place[own], value[own], some.num_rows, len(held))
                    for position, columns in queries:
                        best[position] = index.search(columns, names, k, best.get(position))
        part = TaskContext.get().partitionId() % 256
        for position, (scores, names) in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(scores), position)), pa.array(np.full(len(scores), part, np.int32)),
                    pa.array(names, mask=names == _LAST), pa.array(scores),
                ],
                ["position", "part", "doc_id", "score"],
            )

    return run


class Index:
    """Clustered posting blocks of some documents, and the coordinatewise maximum of each block."""

    def __init__(self, doc: np.ndarray, column: np.ndarray, value: np.ndarray, n_docs: int, n_columns: int) -> None:
        self.values = np.zeros((n_docs, n_columns))  # whole numbers below 2**53, so sums are exact
        self.values[doc, column] = value
        plane = np.random.default_rng(n_columns).standard_normal((n_columns, PLANE))
        sketch = self.values @ plane
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-300)
        order = np.lexsort((doc, column))
        listed, cuts = doc[order], np.searchsorted(column[order], np.arange(n_columns + 1))
        docs, sizes, self.lists = [], [], np.zeros(n_columns + 1, np.int64)
        for c in range(n_columns):
            own = listed[cuts[c] : cuts[c + 1]]
            blocks = -(-len(own) // BLOCK)
            if blocks > 1:
                pivots = own[np.arange(blocks) * len(own) // blocks]
                near = (sketch[own] @ sketch[pivots].T).argmax(1)
                own = own[np.argsort(near, kind="stable")]
                inside = np.bincount(near, minlength=blocks)
                inside = inside[inside > 0]
            else:
                inside = np.array([len(own)] if blocks else [], np.int64)
            docs.append(own)
            sizes.append(inside)
            self.lists[c + 1] = self.lists[c] + len(inside)
        self.docs = np.concatenate([np.zeros(0, np.int64), *docs])
        self.ends = np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)))
        up = np.nextafter(self.values.astype(np.float32), np.float32(np.inf), dtype=np.float32)
        up[self.values == 0] = 0
        self.most = np.zeros((len(self.ends) - 1, n_columns), np.float32)  # not below the exact maxima
        for b, (s, e) in enumerate(zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), strict=True)):
            up[self.docs[s:e]].max(0, out=self.most[b])

    def search(self, columns, names, k, best):
        """The k best (scores, names) of these documents and of `best`, for a query's columns, rarest first."""
        scores, found = best if best is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        blocks, bounds = [], []
        for j, c in enumerate(columns.tolist()):
            s, e = int(self.lists[c]), int(self.lists[c + 1])
            if s < e:
                blocks.append(np.arange(s, e))
                bounds.append(self.most[s:e, columns[j:]].sum(1, dtype=np.float64))
        if not blocks:
            return scores, found
        blocks, bounds = np.concatenate(blocks), np.concatenate(bounds)
        order = np.argsort(-bounds, kind="stable")
        fresh = np.ones(len(self.values), bool)
        for lo in range(0, len(order), STEP):
            step = order[lo : lo + STEP]
            if len(scores) == k:
                step = step[bounds[step] >= scores[-1]]
                if not len(step):
                    break
            own = np.unique(np.concatenate([self.docs[self.ends[b] : self.ends[b + 1]] for b in blocks[step].tolist()]))
            own = own[fresh[own]]
            fresh[own] = False
            sums = self.values[np.ix_(own, columns)].sum(1).astype(np.int64)
            if len(scores) == k:
                near = sums >= scores[-1]
                own, sums = own[near], sums[near]
            scores, found = np.concatenate([scores, sums]), np.concatenate([found, names[own]])
            top = np.lexsort((found, -scores))[:k]
            scores, found = scores[top], found[top]
        return scores, found


#: For DuckDB; the fixed numbers are those of the contract.
ORACLE_SQL = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), scored AS (
    SELECT item_id, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
    GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""
