"""N-gram Jaccard join: documents whose shingle sets are alike, by a blocked sparse matrix product.

Two documents link when 100 * |intersection| >= percent * |union| of their distinct word shingles.
The product of the document by shingle matrix with its transpose holds every overlap; only the blocks
that can hold a link are multiplied:

1. Documents with the same set are one node (the smallest doc_id).
2. Linked sets differ in at most d shingles, and d follows from their size. Each set is cut by hash into
   d + s segments, so two linked sets agree in s whole segments at least. Sets that share a segment are
   candidates. A common passage fills no segment by itself, so it makes no candidates. Empty segments
   count only for a set that has s of them; s is three and three times the share that is expected empty.
   A set is a candidate only if it shares as many segments with the documents of one of 64 parties.
   Of the segments that it shares, those that most sets have are left out, one less than a link takes, as
   two linked sets still share one. The candidates are then cut once more, into d more segments, of which
   a link takes over half: by a share of common passages that is far from a link a set is no candidate,
   however many sets have them, so clusters do not grow together as the table grows.
3. Connected candidates form clusters. Documents in order of cluster and size are cut into blocks of
   bounded weight, and each block is one task. It adds up overlap counts over column slices and discards
   pairs whose sizes, or whose count plus what is left, cannot reach the bound. It returns the smallest
   document of those it found connected for each of them, not all pairs.
4. In clusters over several blocks a set is put in order of how many sets hold a shingle, rarest first.
   Two linked sets share one of their first shingles, and what follows the first shared one in each
   bounds their overlap; what many sets hold comes last and makes no candidates. First each document is
   compared with one document of the largest group known so far that it shares such a shingle with. Then
   it goes to the blocks that hold a candidate not yet known to be connected with it, as both would find
   nothing new otherwise; each pair of blocks is a task as above.

No link that connects different sets is lost, and no group is gathered beyond one block.

Defined cases: a null or wordless text has no shingles and links with nothing. A row without doc_id
links with nothing and has a null component. Rows that repeat a doc_id are one node. Columns other than
doc_id and text are not read. Sets hold 64-bit hashes of shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm import shared
from visitflow.llm.hashing import ShingleSets, Words, bytes_of, mix, restored, squeezed, text_groups

#: Shingles in a block; a document counts ROW_WEIGHT more, which bounds the documents in a block.
BLOCK_WEIGHT = 1 << 18
ROW_WEIGHT = 512
#: Blocks of a cluster up to which documents go to the other blocks without a comparison with one document first.
FEW_BLOCKS = 2
#: Rows of one signature that are held to see who they are from; more are let through as met by all.
WIDE_GROUP = 1 << 16
#: Times the d that the second cut of the candidates has as segments; the first has it once.
FINER = 2
#: Bytes of one dense column slice.
SLICE_BYTES = 32 << 20
SIGNATURES = "sig long, doc_id long, tag int"


def similar_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of docs."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = shared.stored(
        texts.mapInArrow(shared.released(_profiles(width)), "doc_id long, n_shingles long, d1 long, d2 long"), "profile"
    )
    named = profile.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    of_class = named.join(classes, ["d1", "d2"])
    own = shared.stored(
        of_class.groupBy("doc_id").agg(
            F.min("rep").alias("rep"), F.max("rep").alias("last_rep"), F.max("n_shingles").alias("n")
        ),
        "own",
    )
    copies = own.where("last_rep < doc_id").select("doc_id")
    twofold = own.where("rep < last_rep").select("doc_id")
    known = of_class.join(twofold, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    rows = texts.where("doc_id IS NOT NULL").mapInArrow(shared.released(_signatures(width, percent)), SIGNATURES)
    coarse = _alike(_repeated(rows).drop("head").join(copies, "doc_id", "left_anti"))
    packed = texts.where("doc_id IS NOT NULL").mapInArrow(shared.released(_compressed), "doc_id long, text binary")
    near = shared.stored(packed.join(coarse.select("doc_id").distinct(), "doc_id"), "near")
    shared.discard(coarse)
    finer = _signatures(width, percent, FINER)
    again = near.mapInArrow(shared.released(lambda batches: finer(_with_text(1, restored)(batches))), SIGNATURES)
    groups = _alike(_repeated(again).drop("head"))
    clusters = shared.components(groups.select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    nodes = clusters.join(own, F.col("node") == F.col("doc_id")).select(
        F.col("root").alias("cluster"), "n", "doc_id", (F.col("n") + ROW_WEIGHT).alias("weight")
    )
    placed = shared.stored(
        shared.with_rank(nodes, ["cluster", "n", "doc_id"], "weight").select(
            "cluster", "doc_id", F.expr(f"before div {BLOCK_WEIGHT}").alias("block")
        ),
        "placed",
    )
    shared.discard(groups)
    sets = shared.stored(
        near.join(placed, "doc_id").select("block", "cluster", "doc_id", "text").mapInArrow(
            shared.released(_members(width)), "block long, cluster long, doc_id long, grams binary"
        ),
        "sets",
    )
    shared.discard(near)
    found = shared.stored(_multiplied(_paired(sets), percent), "found")
    found = _across(sets, placed, found, percent)
    roots = shared.components(found.unionByName(known))
    shared.discard(sets)  # what was found in them is stored
    lead = own.join(roots, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.coalesce("root", "rep").alias("lead")
    )
    return profile.join(lead, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("lead")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def without_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, one of each group of linked texts and of texts with the same shingles, as they are.

    What links is a text, whatever its doc_id. Of a group the row with the smallest key stays. A row's key
    is its doc_id; rows without one, and rows of a doc_id that other rows have too, get keys below zero
    from doc_id and text, so unlike texts under one doc_id are told apart and all stay. Of rows alike in
    doc_id and text one stays. Texts without words are alike to none, but for such repeated rows.
    """
    columns = [f"_{k}" for k in range(len(docs.columns))]
    at_id, at_text = (columns[docs.columns.index(c)] for c in ("doc_id", "text"))
    rows = docs.toDF(*columns)
    name = F.col(at_id).cast("long")
    shared_ids = shared.stored(
        rows.groupBy(name.alias("_name")).agg(F.count("*").alias("n")).where("n > 1 OR _name IS NULL").select("_name"), "shared-ids"
    )
    single = rows.where(name.isNotNull()).join(shared_ids, name == F.col("_name"), "left_anti").withColumn("_key", name)
    key = -1 - F.shiftrightunsigned(F.xxhash64(F.coalesce(name, F.lit(0)), name.isNull(), F.coalesce(at_text, F.lit("")), F.col(at_text).isNull()), 1)
    several = (
        rows.join(shared_ids, name.eqNullSafe(F.col("_name")), "left_semi").withColumn("_key", key).groupBy("_key")
        .agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("_row")).select(*[f"_row.{c}" for c in columns], "_key")
    )
    rows = single.unionByName(shared.stored(several, "several"))
    groups = similar_groups(rows.select(F.col("_key").alias("doc_id"), F.col(at_text).alias("text")), width, percent)
    others = shared.stored(groups.where("component_id < doc_id").select(F.col("doc_id").alias("_other")).distinct(), "others")
    spot = columns.index(at_text)
    kinds = [f.dataType.simpleString() for f in docs.schema]
    packed = ", ".join(f"{c} {'binary' if c == at_text else t}" for c, t in zip(columns, kinds, strict=True))
    small = rows.mapInArrow(shared.released(_with_text(spot, squeezed)), f"{packed}, _key long")
    left = small.join(others, F.col("_key") == F.col("_other"), "left_anti").drop("_key")
    plain = ", ".join(f"{c} {t}" for c, t in zip(columns, kinds, strict=True))
    return left.mapInArrow(shared.released(_with_text(spot, lambda x: restored(x).cast(pa.string()))), plain).toDF(*docs.columns)


def _with_text(at: int, change):
    """Batches with the text column, the one at this place, changed; texts travel compressed."""

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = change(columns[at])
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def _paired(sets: DataFrame, meets: DataFrame | None = None) -> DataFrame:
    """Rows of sets for each pair of blocks (p, q) to multiply; side says which of the two a row is from.

    Without meets, rows (doc_id, other), a block meets itself as a whole and part is null. With them a document
    goes to the other block, and only a cluster that both hold meets.
    """
    if meets is None:
        return sets.select(
            F.col("block").alias("p"), F.col("block").alias("q"), F.lit(None).cast("long").alias("part"),
            F.lit(0).alias("side"), "cluster", "doc_id", "grams",
        )
    return sets.join(meets, "doc_id").select(
        F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), F.col("cluster").alias("part"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "cluster", "doc_id", "grams",
    )


def _multiplied(paired: DataFrame, percent: int) -> DataFrame:
    return paired.groupBy("p", "q", "part").applyInArrow(_product(percent), shared.EDGES)


def _across(sets: DataFrame, placed: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The links found in blocks, with those that connect more across the blocks of a cluster."""
    blocks = (F.max("block") - F.min("block") + 1).alias("blocks")
    wide = placed.groupBy("cluster").agg(blocks).where("blocks > 1")
    spread = shared.stored(sets.join(wide, "cluster"), "spread")
    first = _first_shingles(spread, percent)

    in_blocks = found.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))  # a block's links lead to one document
    leads = _leads(first.join(_grouped(spread, in_blocks).where(f"blocks > {FEW_BLOCKS}"), "doc_id"), percent)
    a = spread.select(F.col("doc_id").alias("a"), F.col("grams").alias("a_grams"))
    b = spread.select(F.col("doc_id").alias("b"), F.col("grams").alias("b_grams"))
    led = leads.join(a, "a").join(b, "b").mapInArrow(shared.released(_linked(percent)), shared.EDGES)
    found = shared.stored(found.unionByName(led), "found")

    meets = _meets(first.join(_grouped(spread, shared.components(found)), "doc_id"), percent)
    met = shared.stored(_multiplied(_paired(spread, shared.stored(meets, "meets")), percent), "found")
    shared.discard(first)
    shared.discard(spread)
    return found.unionByName(met)


def _first_shingles(spread: DataFrame, percent: int) -> DataFrame:
    """Stored rows (gram, doc_id, n, rest) of the shingles, hashed with the cluster, by which a set may find a linked one.

    In one order of a cluster's shingles, the rarest first, `rest` of a set's n shingles are this one or
    later. Linked sets share a shingle which has at least the share of a link left in both of them.
    Shingles that no other row has come first and are only counted. Shingles are counted in each block, and
    a block gets their numbers in the cluster back: one row for each of its different shingles, however many
    of its documents have it. Rows that repeat a document count twice, which lets more through.
    """
    here = shared.stored(
        spread.groupBy("block", "cluster").applyInArrow(_counted, "block long, cluster long, gram long, here long"), "counted"
    )
    often = here.groupBy("gram").agg(F.sum("here").alias("often")).where("often > 1")
    known = here.join(often, "gram").select("block", "cluster", "gram", "often")
    docs = spread.select("block", "cluster", "doc_id", "grams")
    both = docs.groupBy("block", "cluster").cogroup(known.groupBy("block", "cluster"))
    first = shared.stored(both.applyInArrow(_rarest(percent), "gram long, doc_id long, n long, rest long"), "first")
    shared.discard(here)
    return first


def _grouped(spread: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (doc_id, block, blocks, root, size): which documents are known to be connected, and how many."""
    named = spread.select("doc_id", "block", "blocks").distinct().join(roots, F.col("doc_id") == F.col("node"), "left")
    named = shared.stored(named.withColumn("root", F.coalesce("root", "doc_id")).drop("node"), "named")
    return named.join(named.groupBy("root").agg(F.count("*").alias("size")), "root")


def _may_link(percent: int, n: Column, least: Column, most: Column, rest: Column, other_rest: Column) -> Column:
    """Whether a set of n shingles may link with one of least to most, with so many left in each at a shared one."""
    sizes = (100 * n >= percent * least) & (100 * most >= percent * n)
    return sizes & ((100 + percent) * F.least(rest, other_rest) >= percent * (n + least))


def _leads(first: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), one for each document a that has one: b is of a larger group and shares the most first shingles."""
    heads = (
        first.groupBy("gram").agg(
            F.max(F.struct("size", "root", "rest", "doc_id", "n")).alias("head"), F.min("root").alias("least"), F.max("root").alias("most")
        )
        .where("least < most").select("gram", "head")
    )
    head = F.col("head")
    near = _may_link(percent, F.col("n"), head.n, head.n, F.col("rest"), head.rest)
    return (
        first.join(heads, "gram").where((F.col("root") != head.root) & near)
        .groupBy("doc_id", F.col("head.doc_id").alias("b")).agg(F.count("*").alias("k"))
        .groupBy(F.col("doc_id").alias("a")).agg(F.max(F.struct("k", "b")).alias("best")).select("a", "best.b")
    )


def _meets(first: DataFrame, percent: int) -> DataFrame:
    """Rows (doc_id, other): the other blocks with documents that it may link with and is not yet connected to.

    Of the groups that have a shingle in a block, the two with the most left at it stand for all: one of them
    is not the document's own, and no other has more left. So a document meets two rows a block, not every group.
    """
    open_grams = (
        first.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low < high").select("gram")
    )
    left = shared.stored(first.join(open_grams, "gram"), "open")
    one = Window.partitionBy("gram", "other")
    there = (
        left.groupBy("gram", F.col("block").alias("other"), F.col("root").alias("other_root"))
        .agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("other_rest"))
        .select(
            "gram", "other", "other_root", "other_rest", F.min("least").over(one).alias("least"), F.max("most").over(one).alias("most"),
            F.row_number().over(one.orderBy(F.desc("other_rest"), "other_root")).alias("place"),
        )
        .where("place <= 2").drop("place")
    )
    near = _may_link(percent, *map(F.col, ("n", "least", "most", "rest", "other_rest")))
    return (
        left.join(there, "gram")
        .where((F.col("block") != F.col("other")) & (F.col("root") != F.col("other_root")) & near)
        .select("doc_id", "other").distinct()
    )


def _grams(table: pa.Table) -> list[np.ndarray]:
    """The shingles of each row of one cluster, hashed with the cluster."""
    cluster = mix(table.column("cluster").to_numpy()[:1].view(np.uint64))
    column = table.column("grams").combine_chunks()
    return [mix(np.frombuffer(own.as_buffer(), np.uint64) ^ cluster).view(np.int64) for own in column]


def _counted(table: pa.Table) -> pa.Table:
    """How many rows of a block and cluster have a shingle."""
    gram, here = np.unique(np.concatenate(_grams(table)), return_counts=True)
    block, cluster = (np.full(len(gram), table.column(c)[0].as_py(), np.int64) for c in ("block", "cluster"))
    shared.release()
    return pa.table({"block": block, "cluster": cluster, "gram": gram, "here": here.astype(np.int64)})


def _rarest(percent: int):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by([("often", "ascending"), ("gram", "ascending")])
        ordered = known.column("gram").to_numpy()
        by_gram = np.argsort(ordered)
        found = ordered[by_gram]
        out = [np.zeros((4, 0), np.int64)]
        for doc_id, own in zip(docs.column("doc_id").to_pylist(), _grams(docs), strict=True):
            spot = np.searchsorted(found, own)
            spot = spot[np.append(found, 0)[spot] == own]
            spot = np.sort(by_gram[spot[spot < len(found)]])
            rest = len(spot) - np.arange(len(spot))
            spot, rest = (x[100 * rest >= percent * len(own)] for x in (spot, rest))
            one = np.ones(len(spot), np.int64)
            out.append(np.stack([ordered[spot], one * doc_id, one * len(own), rest]))
        gram, doc_id, n, rest = np.concatenate(out, axis=1)
        shared.release()
        return pa.table({"gram": gram, "doc_id": doc_id, "n": n, "rest": rest})

    return run


def _linked(percent: int):
    """The pairs (a, b) whose sets link."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_grams"), batch.column("b_grams"), strict=True):
                one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, ShingleSets]]:
    raw, at = bytes_of(batch.column("text"))
    for i, j in text_groups(at):
        yield i, j, ShingleSets(Words(raw[at[i] : at[j]], at[i : j + 1] - at[i], lower=True), width)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def _profiles(width: int):
    def run(batches):
        for batch in batches:
            for i, j, sets in _sets_of(batch, width):
                begins = sets.ends - sets.sizes
                digests = b"".join(
                    hashlib.md5(sets.values[s:e].tobytes(), usedforsecurity=False).digest()
                    for s, e in zip(begins.tolist(), sets.ends.tolist(), strict=True)
                )
                pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield _batch(
                    doc_id=batch.column("doc_id").slice(i, j - i),
                    n_shingles=sets.sizes,
                    d1=np.ascontiguousarray(pair[:, 0]),
                    d2=np.ascontiguousarray(pair[:, 1]),
                )

    return run


def _compressed(batches):
    for batch in batches:
        yield _batch(doc_id=batch.column("doc_id"), text=squeezed(batch.column("text")))


def _members(width: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                own = batch.slice(k, 1)
                raw, at = bytes_of(restored(own.column("text")))
                sets = ShingleSets(Words(raw, at, lower=True), width)
                yield _batch(
                    block=own.column("block"), cluster=own.column("cluster"), doc_id=own.column("doc_id"),
                    grams=pa.array([sets.values.tobytes()], pa.binary()),
                )

    return run


def _signatures(width: int, percent: int, finer: int = 1):
    """Rows (sig, doc_id, tag): the hash of each segment of each set, under the labels of two size classes.

    The tag holds the label and, in its last eight bits, how many rows of the label a set linked to another
    shares at least.

    Sizes of class c lie in [bounds[c], bounds[c + 1]), and linked sets are in the same class or in
    neighbours. Label c serves sets of class c - 1 with each other and with class c; the smaller of two
    linked sets has under bounds[c] shingles, so they differ in at most (100 - percent) / percent of that.
    There are `finer` times as many segments as that, and some to spare; all but that many agree.
    """
    ratio = 100 / percent
    spare_share = 3 * np.exp(-percent / max(100 - percent, 1e-9))
    bounds = 0.917 * ratio ** np.arange(int(np.log(1 << 40) / np.log(ratio)) + 2) if percent < 100 else None

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for i, j, sets in _sets_of(batch, width):
                if bounds is None or not len(sets.values):
                    continue
                scrambled = mix(sets.values ^ np.uint64(0x51ED270B9F8C4F25))
                owner = np.repeat(np.arange(j - i), sets.sizes)
                upper = np.searchsorted(bounds, np.maximum(sets.sizes, 1), "right") - 1
                for label in (upper, upper + 1):
                    most = np.ceil(bounds[label]).astype(np.int64) - 1
                    differ = most * (100 - percent) // percent
                    spare = 3 + np.ceil(np.minimum(spare_share, 1) * differ).astype(np.int64) + (finer - 1) * differ
                    segments = np.where((differ > 0) & (sets.sizes > 0), differ + spare, 0)
                    base = np.cumsum(segments) - segments
                    wide = segments[owner]
                    used = wide > 0
                    of = owner[used]
                    spot = base[of] + (scrambled[used] % wide[used].astype(np.uint64)).astype(np.int64)
                    total = int(segments.sum())
                    if not total:
                        continue
                    sums = np.zeros(total, np.uint64)
                    np.add.at(sums, spot, sets.values[used])
                    filled = np.zeros(total, bool)
                    filled[spot] = True
                    doc = np.repeat(np.arange(j - i), segments)
                    blank = segments - np.bincount(doc[filled], minlength=j - i)
                    keep = filled | (blank >= spare)[doc]  # so many empty segments may be all that two sets share
                    number = (np.arange(total) - base[doc]).astype(np.uint64)
                    tag = mix((label[doc].astype(np.uint64) << np.uint64(40)) + number + np.uint64(1))
                    sig = (mix(sums + tag) >> np.uint64(16))[keep]  # 48 bits, for short rows; what collides is told apart by the product
                    need = np.clip(spare - blank, 1, 255)
                    mark = (label * 256 + need).astype(np.int32)
                    yield _batch(sig=sig.view(np.int64), doc_id=ids[i:j][doc[keep]].astype(np.int64), tag=mark[doc[keep]])

    return run


def _alike(rows: DataFrame) -> DataFrame:
    """Stored rows (sig, doc_id, tag, head) that connect what may link, from rows that other documents have too."""
    hits = shared.stored(rows, "hits")
    groups = shared.stored(_repeated(_enough(hits)), "groups")
    shared.discard(hits)
    return groups


def _enough(rows: DataFrame) -> DataFrame:
    """Rows of the documents and labels that share as many rows as a link takes with the documents of one party.

    Of these, the rows that most documents have are left out, see _without_common.

    Documents are dealt by hash into 64 parties. What a document shares with many others, a row with each, as
    a common passage makes it do, grows with the table; what it shares with one party does so 64 times less.
    """
    n = shared.parts(rows.sparkSession)
    met = (
        rows.select("sig", "doc_id", "tag").repartition(n, "sig").sortWithinPartitions("sig")
        .mapInArrow(shared.released(_met), f"{SIGNATURES}, others long, many int")
    )
    by_doc = met.repartition(n, "doc_id").sortWithinPartitions("doc_id", "tag")
    return by_doc.mapInArrow(shared.released(lambda batches: _without_common(_sharing(batches, "many"))), SIGNATURES)


def _whole_groups(batches, names: tuple[str, ...], keys: int, most: int | None = None):
    """Columns of sorted rows, cut where the first `keys` columns change; True after a cut inside a group of over `most` rows."""
    held = None
    for batch in batches:
        fresh = [batch.column(c).to_numpy() for c in names]
        held = fresh if held is None else [np.concatenate(x) for x in zip(held, fresh, strict=True)]
        changes = np.flatnonzero(np.any([k[1:] != k[:-1] for k in held[:keys]], axis=0))
        if len(changes):
            cut = int(changes[-1]) + 1
            yield [x[:cut] for x in held], False
            held = [x[cut:] for x in held]
        if most is not None and len(held[0]) > most:
            yield held, True
            held = None
    if held is not None and len(held[0]):
        yield held, False


def _met(batches):
    """Rows whose signature other rows have too, with the parties (bits) of those; all bits in very large groups.

    `many` is how many rows have the signature, WIDE_GROUP at most, the same in each of them.
    """
    wide = None
    for (sig, doc, tag), inside in _whole_groups(batches, ("sig", "doc_id", "tag"), 1, WIDE_GROUP):
        fresh = np.ones(len(sig), bool)
        fresh[1:] = sig[1:] != sig[:-1]
        group = np.cumsum(fresh) - 1
        party = (mix(doc.view(np.uint64)) & np.uint64(63)).astype(np.int64)
        bit = np.uint64(1) << party.astype(np.uint64)
        together = np.bitwise_or.reduceat(bit, np.flatnonzero(fresh))
        _, of, count = np.unique(group * 64 + party, return_inverse=True, return_counts=True)
        others = together[group] & ~np.where(count[of] > 1, np.uint64(0), bit)
        open_end = sig == wide if wide is not None else np.zeros(len(sig), bool)
        if inside:
            wide = sig[-1]
            open_end |= sig == wide
        others[open_end] = ~np.uint64(0)
        many = np.where(open_end, WIDE_GROUP, np.minimum(np.bincount(group)[group], WIDE_GROUP)).astype(np.int32)
        keep = others > 0
        yield _batch(sig=sig[keep], doc_id=doc[keep], tag=tag[keep], others=others[keep].view(np.int64), many=many[keep])


def _sharing(batches, *more: str):
    """Rows met by a party that meets enough rows of the document and label, whole in a batch; with more columns, if named."""
    for (doc, tag, sig, others, *rest), _ in _whole_groups(batches, ("doc_id", "tag", "sig", "others", *more), 2):
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
        begins = np.flatnonzero(fresh)
        bits = np.unpackbits(others.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        enough = np.add.reduceat(bits, begins, axis=0, dtype=np.int64) >= (tag[begins] % 256)[:, None]
        keep = (bits & enough[np.cumsum(fresh) - 1]).any(axis=1)
        yield _batch(sig=sig[keep], doc_id=doc[keep], tag=tag[keep], **{c: x[keep] for c, x in zip(more, rest, strict=True)})


def _without_common(batches):
    """Rows less those that most rows share, one less of a document and label than a link takes.

    All documents have the signatures in the same order, so of those that two linked sets share the rarest
    is left in both. What many sets have connects none that do not share something rarer, or more of it.
    """
    for batch in batches:
        doc, tag, sig, many = (batch.column(c).to_numpy() for c in ("doc_id", "tag", "sig", "many"))
        order = np.lexsort((sig, -many, tag, doc))
        doc, tag, sig = doc[order], tag[order], sig[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
        place = np.arange(len(doc)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        keep = place >= tag % 256 - 1
        yield _batch(sig=sig[keep], doc_id=doc[keep], tag=tag[keep])


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows (sig, doc_id, tag, head) of signatures that more than one row has; head is the smallest doc_id.

    Rows come sorted, and one pass over them keeps only the row before.
    """
    n = shared.parts(rows.sparkSession)
    dealt = rows.select("sig", "doc_id", "tag").repartition(n, "sig").sortWithinPartitions("sig", "doc_id")
    return dealt.mapInArrow(shared.released(_runs), "sig long, doc_id long, tag int, head long")


def _runs(batches):
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    last, head = None, 0
    for batch in batches:
        held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("sig", "doc_id", "tag"), strict=True)]
        if len(held[0]) > 1:
            out, last, head = _marked(*held, len(held[0]) - 1, last, head)
            yield out
            held = [h[-1:] for h in held]
    if len(held[0]):
        yield _marked(*held, len(held[0]), last, head)[0]


def _marked(sig, doc, tag, n, last, head):
    """The first n rows as output; the row after them, if any, tells whether the n-th is repeated."""
    same = np.empty(n, bool)
    same[0] = last is not None and sig[0] == last
    same[1:] = sig[1:n] == sig[: n - 1]
    follows = np.zeros(n, bool)
    follows[: len(sig) - 1] = sig[1 : n + 1] == sig[: min(n, len(sig) - 1)]
    first = np.maximum.accumulate(np.where(same, -1, np.arange(n)))
    heads = np.where(first < 0, head, doc[np.maximum(first, 0)])
    keep = same | follows
    out = _batch(sig=sig[:n][keep], doc_id=doc[:n][keep], tag=tag[:n][keep], head=heads[keep])
    return out, sig[n - 1], heads[-1]


def _product(percent: int):
    def run(table: pa.Table) -> pa.Table:
        across = table.column("part").null_count == 0
        table = table.select(["side", "cluster", "doc_id", "grams"]).sort_by([("cluster", "ascending"), ("doc_id", "ascending")])
        side = table.column("side").to_numpy()
        cluster = table.column("cluster").to_numpy()
        ids = table.column("doc_id").to_numpy()
        grams = table.column("grams").combine_chunks()
        edges: list[tuple[int, int]] = []
        cuts = [0, *(np.flatnonzero(cluster[1:] != cluster[:-1]) + 1).tolist(), len(cluster)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if e - s < 2:
                continue
            values = [np.frombuffer(grams[k].as_buffer(), np.uint64) for k in range(s, e)]
            left, right = np.flatnonzero(side[s:e] == 0), np.flatnonzero(side[s:e] == 1)
            i, j = linked_pairs(values, left, right if across else left, percent)
            edges += _spanning(ids[s:e], i, j)
            del values, i, j
        shared.release()
        return pa.table(
            {"a": pa.array([x for x, _ in edges], pa.int64()), "b": pa.array([y for _, y in edges], pa.int64())}
        )

    return run


def linked_pairs(values: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """Index pairs (i, j) of values, i from left and j from right, that link."""
    sizes = np.array([len(v) for v in values], np.int64)
    rows = np.repeat(np.arange(len(values)), sizes)
    column, inverse, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    held = count[inverse] > 1
    rows, inverse = rows[held], column[inverse[held]]
    order = np.argsort(inverse, kind="stable")
    rows, inverse = rows[order], inverse[order]
    a, b = sizes[left][:, None], sizes[right][None, :]
    possible = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    if left is right:
        possible &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    kind = np.float32 if sizes.max(initial=0) < 1 << 24 else np.float64  # counts stay exact
    overlap = np.zeros(possible.shape, kind)
    to_left, to_right = np.full(len(values), -1), np.full(len(values), -1)
    to_left[left], to_right[right] = np.arange(len(left)), np.arange(len(right))
    rest_left = np.bincount(rows, minlength=len(values))[left]
    rest_right = np.bincount(rows, minlength=len(values))[right]
    total = int(inverse[-1]) + 1 if len(inverse) else 0
    step = max(1, SLICE_BYTES // (overlap.itemsize * (len(left) + len(right))))
    for begin in range(0, total, step):
        if not possible.any():
            break
        lo, hi = np.searchsorted(inverse, [begin, begin + step])
        r, c = rows[lo:hi], inverse[lo:hi] - begin
        wide = min(step, total - begin)
        dense_left, dense_right = np.zeros((len(left), wide), kind), np.zeros((len(right), wide), kind)
        mine, theirs = to_left[r] >= 0, to_right[r] >= 0
        dense_left[to_left[r[mine]], c[mine]] = 1
        dense_right[to_right[r[theirs]], c[theirs]] = 1
        live_left, live_right = possible.any(1), possible.any(0)
        overlap[np.ix_(live_left, live_right)] += dense_left[live_left] @ dense_right[live_right].T
        rest_left = rest_left - dense_left.sum(1).astype(np.int64)
        rest_right = rest_right - dense_right.sum(1).astype(np.int64)
        reach = overlap + np.minimum(rest_left[:, None], rest_right[None, :])
        possible &= (100 + percent) * reach.astype(np.float64) >= percent * (a + b)
    linked = possible & ((100 + percent) * overlap.astype(np.float64) >= percent * (a + b))
    i, j = np.nonzero(linked)
    return left[i], right[j]


def _spanning(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (a, b) for each document b that links connect with a smaller one; a is the smallest of them."""
    lead: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := lead.get(x, x)) != x:
            lead[x] = lead.get(up, up)
            x = up
        return x

    for x, y in zip(ids[i].tolist(), ids[j].tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            lead[max(p, q)] = min(p, q)
    return [(top(x), x) for x in list(lead) if top(x) != x]


#: For DuckDB: overlaps of all pairs of sets of three-word shingles that share one.
ORACLE_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM split WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y USING (gram) WHERE x.doc_id < y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs o JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * o.n >= 90 * (s.n + t.n - o.n)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM reach JOIN both_ways ON a = node
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(root) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach ON node = d.doc_id GROUP BY d.doc_id, s.n
"""
