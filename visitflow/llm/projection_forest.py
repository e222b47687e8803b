"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

1. Equal directions are one node, so copies are never compared with each other.
2. Each tree splits the nodes round by round. In a round, a bounded sample of each bucket that is too large (about
   SAMPLE of its nodes, chosen by hash) fits a small tree: at each split, of some random directions and thresholds near
   the median, the one with the fewest nodes in its margin. Every node is then routed, and one that lies within the
   margin goes to both sides. The margin is half the typical distance of projections of two vectors at the
   threshold, so two linked vectors rarely part. A bucket that no split divides without putting most of it on
   both sides is a dense one and stays whole.
3. Nodes are compared within leaves: all of a leaf at once, or a dense leaf in pairs of blocks of bounded size. Cosines
   are taken in double precision, so no pair below the threshold links. A pair that meets in several leaves counts
   in the first. Each leaf gives one count for each node, and as many links as connect its components, not its pairs.
4. Components of the union of all trees' links are found by shared.components.

What can be missed is a linked pair that every tree parts; tests and the README state the recall. Comparing a dense
leaf takes work that grows with the square of its nodes, as its links do; memory does not.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component links with nothing, as do
vectors of different lengths. A row without vec_id links with nothing, has a null component and is kept. Rows that
repeat a vec_id are each returned; they count as other vectors for each other. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm import shared
from visitflow.llm.hashing import mix

#: Nodes of a leaf, at most, unless it is dense; nodes that are compared with each other in one task.
LEAF, COMPARED = 512, 4096
#: Nodes that fit the splits of one bucket in one round, about; splits from root to leaf in a round.
SAMPLE, DEPTH = 2048, 6
#: Random directions tried for a split; most nodes that a split may put on both sides, as a share.
TRIES, SPILL = 8, 0.5
_ROWS = 512


def near_groups(vectors: DataFrame, cosine: float = 0.9, trees: int = 4) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row (vec_id, embedding) of vectors."""
    element = vectors.schema["embedding"].dataType.elementType.typeName()
    kind = "<f4" if element == "float" else "<f8"
    rows = shared.stored(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{'float' if kind == '<f4' else 'double'}>").alias("embedding"))
        .mapInArrow(_digested(kind), "vec_id long, dim int, d1 long, d2 long, vector binary"),
        "vectors",
    )
    nodes = shared.stored(
        rows.where("dim > 0 AND vec_id IS NOT NULL").groupBy("d1", "d2").agg(
            F.min("vec_id").alias("lead"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("vector").alias("vector")
        ).withColumnRenamed("d1", "node"),
        "nodes",
    )
    leaves = _forest(nodes, kind, cosine, trees)
    met = shared.stored(_compared(nodes, leaves, kind, cosine), "met")
    links = met.groupBy("node", "d2").agg(F.sum("links").alias("links"))
    edges = met.where("lead <> least").select(F.col("lead").alias("a"), F.col("least").alias("b"))
    roots = shared.components(edges)
    found = (
        nodes.select("node", "d2", "lead", "copies").join(links, ["node", "d2"], "left")
        .join(roots.withColumnRenamed("node", "lead"), "lead", "left")
        .select(
            F.col("node").alias("d1"), "d2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "lead").alias("component_id"),
        )
    )
    usable = (F.col("dim") > 0) & F.col("vec_id").isNotNull()
    both = rows.drop("vector").withColumn("d1", F.when(usable, F.col("d1"))).join(found, ["d1", "d2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return both.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _digested(kind: str):
    """Each usable vector's components and the digest of its direction; dim is 0 for the others."""

    def run(batches):
        for batch in batches:
            lists = batch.column("embedding")
            sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            parts = lists.flatten()
            values = np.where(parts.is_null().to_numpy(zero_copy_only=False), np.nan, parts.fill_null(0).to_numpy(zero_copy_only=False)).astype(kind)
            ends = np.cumsum(sizes)
            dims, digests, out = np.zeros(len(sizes), np.int32), [], []
            for k, (s, e) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
                own = values[s:e]
                if e > s and np.isfinite(own).all() and own.any():
                    dims[k] = e - s
                    out.append(own.tobytes())
                    digests.append(hashlib.md5(_units([out[-1]], kind).tobytes(), usedforsecurity=False).digest())
                else:
                    out.append(b"")
                    digests.append(bytes(16))
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"), "dim": pa.array(dims), "d1": pa.array(pair[:, 0].copy()),
                    "d2": pa.array(pair[:, 1].copy()), "vector": pa.array(out, pa.binary()),
                }
            )

    return run


def _units(vectors: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    return x + 0.0  # no negative zeros


def _forest(nodes: DataFrame, kind: str, cosine: float, trees: int) -> DataFrame:
    """Rows (node, d2, leaf): the leaves that each node lies in, of all trees."""
    placed = shared.stored(
        nodes.select(
            "node", "d2", F.explode(F.sequence(F.lit(1), F.lit(trees))).alias("tree"), F.col("dim").cast("long").alias("bucket"),
            F.lit(False).alias("whole"),
        ),
        "placed",
    )
    here = ["tree", "bucket"]
    while True:
        large = shared.stored(placed.where("NOT whole").groupBy(*here).agg(F.count("*").alias("n")).where(F.col("n") > LEAF), "large")
        if large.isEmpty():
            return placed.select("node", "d2", F.xxhash64("tree", "bucket").alias("leaf"))
        asked = placed.where("NOT whole").join(large, here).join(nodes.select("node", "d2", "vector"), ["node", "d2"])
        chance = F.shiftrightunsigned(F.xxhash64("node", "bucket", "tree"), 11) / F.lit(float(1 << 53))
        fits = shared.stored(
            asked.where(chance * F.col("n") < SAMPLE).groupBy(*here).applyInArrow(
                _fitted(kind, cosine), "tree int, bucket long, splits binary"
            ),
            "fits",
        )
        routes = asked.join(fits, here).select("node", "d2", *here, "vector", "splits").sortWithinPartitions(*here)
        moved = routes.mapInArrow(
            _routed(kind, cosine), "node long, d2 long, tree int, bucket long, whole boolean"
        )
        before, placed = placed, shared.stored(placed.join(large.select(*here), here, "left_anti").select(placed.columns).unionByName(moved), "placed")
        shared.discard(before)


_SPLIT = np.dtype([("seed", "<u8"), ("threshold", "<f8"), ("low", "<i4"), ("high", "<i4")])


def _margin(cosine: float, dim: int) -> float:
    return 0.5 * float(np.sqrt(2 - 2 * cosine) / np.sqrt(dim))


def _direction(seed: int, dim: int) -> np.ndarray:
    out = np.random.default_rng(seed).standard_normal(dim)
    return out / np.linalg.norm(out)


def _fitted(kind: str, cosine: float):
    """The splits of one bucket. A child that is not a split is -1 - 2 * number, or -2 - 2 * number if it is dense."""

    def run(table: pa.Table) -> pa.Table:
        tree, bucket, n = (table.column(c)[0].as_py() for c in ("tree", "bucket", "n"))
        table = table.sort_by([("node", "ascending"), ("d2", "ascending")])  # the same fit if the task is repeated
        units = _units(table.column("vector").to_pylist(), kind)
        margin, share = _margin(cosine, units.shape[1]), n / len(units)
        splits: list[tuple[int, float, int, int]] = []
        leaves = 0

        def leaf(dense: bool) -> int:
            nonlocal leaves
            leaves += 1
            return -1 - 2 * (leaves - 1) - dense

        def grow(own: np.ndarray, depth: int, path: int) -> int:
            if depth == DEPTH or (depth and (len(own) * share <= LEAF or len(own) < 32)):
                return leaf(False)
            seeds = [int(mix(np.array([path * TRIES + k], np.uint64) + np.uint64(bucket & (1 << 63) - 1) + (np.uint64(tree) << np.uint64(56)))[0]) for k in range(TRIES)]
            at = units[own] @ np.stack([_direction(s, units.shape[1]) for s in seeds], axis=1)
            cuts = np.quantile(at, (0.35, 0.5, 0.65), axis=0)
            spilt = (np.abs(at[None] - cuts[:, None]) <= margin).mean(1)
            larger = 0.5 + np.abs(0.5 - (at[None] < cuts[:, None]).mean(1)) + spilt / 2
            spilt = np.where(larger > 0.9, 1.0, spilt)
            q, k = np.unravel_index(spilt.argmin(), spilt.shape)
            if spilt[q, k] > SPILL:
                return leaf(True)
            here, cut = len(splits), float(cuts[q, k])
            splits.append((seeds[k], cut, 0, 0))
            low = grow(own[at[:, k] <= cut + margin], depth + 1, 2 * path)
            high = grow(own[at[:, k] >= cut - margin], depth + 1, 2 * path + 1)
            splits[here] = (seeds[k], cut, low, high)
            return here

        grow(np.arange(len(units)), 0, 1)
        return pa.table({"tree": pa.array([tree], pa.int32()), "bucket": [bucket], "splits": pa.array([np.array(splits, _SPLIT).tobytes()], pa.binary())})

    return run


def _routed(kind: str, cosine: float):
    """Each node in the leaves that the splits of its bucket lead it to; in one as large if there is no split."""

    def run(batches):
        known: dict[int, np.ndarray] = {}  # directions; rows come sorted by bucket
        for batch in batches:
            if len(known) > SAMPLE:
                known = {}
            tree, bucket = batch.column("tree").to_numpy(), batch.column("bucket").to_numpy()
            order = np.lexsort((bucket, tree))
            cuts = np.flatnonzero((np.diff(tree[order]) != 0) | (np.diff(bucket[order]) != 0)) + 1
            rows, names, whole = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for own in np.split(order, cuts) if len(order) else []:
                splits = np.frombuffer(batch.column("splits")[int(own[0])].as_py(), _SPLIT)
                units = _units([batch.column("vector")[k].as_py() for k in own.tolist()], kind)
                margin, name = _margin(cosine, units.shape[1]), np.uint64(int(bucket[own[0]]) & (1 << 64) - 1)
                todo = [(0 if len(splits) else -2, np.arange(len(own)))]
                while todo:
                    s, some = todo.pop()
                    if s >= 0:
                        seed = int(splits["seed"][s])
                        if seed not in known or len(known[seed]) != units.shape[1]:
                            known[seed] = _direction(seed, units.shape[1])
                        at = units[some] @ known[seed] - splits["threshold"][s]
                        todo += [(int(splits["low"][s]), some[at <= margin]), (int(splits["high"][s]), some[at >= -margin])]
                        continue
                    child = mix(mix(name[None]) + np.uint64(-s)).view(np.int64)
                    rows.append(own[some])
                    names.append(np.repeat(child, len(some)))
                    whole.append(np.full(len(some), s % 2 == 0))
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(at) for c in ("node", "d2", "tree")] + [pa.array(np.concatenate(names)), pa.array(np.concatenate(whole))],
                ["node", "d2", "tree", "bucket", "whole"],
            )

    return run


def _compared(nodes: DataFrame, leaves: DataFrame, kind: str, cosine: float) -> DataFrame:
    """Rows (node, d2, lead, links, least): links found in one leaf, and the smallest lead it reaches there."""
    sizes = leaves.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
    blocks = shared.stored(sizes.select("leaf", F.ceil(F.col("n") / COMPARED).alias("blocks")), "blocks")
    held = leaves.join(blocks, "leaf")
    own = held.groupBy("node", "d2").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))  # bounded: leaves of a node
    block, other = F.pmod(F.xxhash64("node", "d2"), "blocks"), F.explode(F.expr("sequence(0L, blocks - 1)"))
    rows = (
        nodes.select("node", "d2", "lead", "copies", "vector").join(own, ["node", "d2"]).join(held, ["node", "d2"])
        .withColumn("block", block).withColumn("other", other)
        .select(
            "leaf", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block",
            "node", "d2", "lead", "copies", "leaves", "vector",
        )
    )
    return rows.groupBy("leaf", "p", "q").applyInArrow(
        _leaf_links(kind, cosine), "node long, d2 long, lead long, links long, least long"
    )


def _leaf_links(kind: str, cosine: float):
    def run(table: pa.Table) -> pa.Table:
        leaf, p, q = (table.column(c)[0].as_py() for c in ("leaf", "p", "q"))
        table = table.sort_by([("block", "ascending"), ("lead", "ascending"), ("node", "ascending")])
        units = _units(table.column("vector").to_pylist(), kind)
        lead, copies = table.column("lead").to_numpy(), table.column("copies").to_numpy()
        n = len(units)
        cut = int((table.column("block").to_numpy() == p).sum())
        left, right = (np.arange(n), np.arange(n)) if p == q else (np.arange(cut), np.arange(cut, n))
        linked = np.zeros((len(left), len(right)), bool)
        for s in range(0, len(left), _ROWS):
            linked[s : s + _ROWS] = units[left[s : s + _ROWS]] @ units[right].T >= cosine
        if p == q:
            np.fill_diagonal(linked, False)
        least = lead.copy()
        while True:  # the smallest lead within reach, by steps along links
            now = least.copy()
            for s in range(0, len(left), _ROWS):
                part = linked[s : s + _ROWS]
                some = left[s : s + _ROWS]
                now[some] = np.minimum(now[some], np.where(part, least[right][None], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
                now[right] = np.minimum(now[right], np.where(part, now[some][:, None], np.iinfo(np.int64).max).min(0, initial=np.iinfo(np.int64).max))
            if (now == least).all():
                break
            least = now
        earlier = _earlier(table.column("leaves"), leaf, np.unique(np.concatenate([left[linked.any(1)], right[linked.any(0)]])), n)
        links = np.zeros(n, np.int64)
        for s in range(0, len(left), _ROWS):
            part, some = linked[s : s + _ROWS], left[s : s + _ROWS]
            if not part.any():
                continue
            if earlier.shape[1]:
                part = part & ~(earlier[some] @ earlier[right].T > 0)
            links[some] += part @ copies[right]
            if p != q:
                links[right] += part.T @ copies[some]
        met = np.flatnonzero((links > 0) | (least != lead))
        return pa.table(
            {
                "node": table.column("node").take(pa.array(met)), "d2": table.column("d2").take(pa.array(met)),
                "lead": pa.array(lead[met]), "links": pa.array(links[met]), "least": pa.array(least[met]),
            }
        )

    return run


def _earlier(leaves: pa.ChunkedArray, leaf: int, some: np.ndarray, n: int) -> np.ndarray:
    """Which of these nodes lie in which smaller-numbered leaves that hold two of them or more."""
    flat = leaves.combine_chunks()
    sizes = flat.value_lengths().to_numpy()
    row, name = np.repeat(np.arange(n), sizes), flat.flatten().to_numpy()
    wanted = np.zeros(n, bool)
    wanted[some] = True
    keep = wanted[row] & (name < leaf)
    row, name = row[keep], name[keep]
    names, column, count = np.unique(name, return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    out = np.zeros((n, int((count > 1).sum())), np.float32)
    out[row[keep], place[column[keep]]] = 1
    return out


#: For DuckDB: all pairs. Equal to the operator's rows where no linked pair is missed, as in tables of one leaf.
ORACLE_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding::DOUBLE[] IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding::DOUBLE[] IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach(node, root) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node
), lead AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(counts.n, 0)::BIGINT AS n_links, lead.root AS component_id, e.vec_id = lead.root AS kept
FROM embeddings e LEFT JOIN counts ON counts.a = e.vec_id LEFT JOIN lead ON lead.node = e.vec_id
"""
