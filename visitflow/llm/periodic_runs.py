"""Periodic stretches of words, found online by a suffix automaton with link-cut access.

A run is a stretch of neighbouring words with smallest period q (words q apart are the same) whose length is
`power` times q and `least` words at least, and that no neighbouring word extends.

1. A run repeats each pair of neighbouring words at a distance of at most q, for (power - 1) * q - 1 pairs in a
   row. Stretches that have no such row at any power of two hold no run; they are left out, a whole batch of
   documents at a time. A window of the rest is cut out with room for one period before it.
2. Each word of a window is appended to a suffix automaton. The tree of its suffix links is kept as preferred
   paths in splay trees; all strings on one path have the same last end. Access from the new state walks the
   paths up to the root and recolours them with the new end. A path's part that was last seen at end e, with
   strings of up to n words, shows a repetition of period d = end - e, of n + d words at least. Since e is the
   last end, d is the smallest period.
3. A repetition is extended both ways in its document to the run that holds it.

Work is n log n steps for n words in windows; memory is that of the automaton of one window. Words are compared
by 64-bit hashes.

Defined cases: a null, empty or short text has no runs. A row without doc_id is scanned like others; repeated rows
are each returned. Runs may overlap, when their periods differ. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.hashing import Words, bytes_of, mix, text_groups
from visitflow.llm.hashing import runs as shingles

#: Bytes of texts that are handled at once, but for one text more; small, as a text's words become objects.
TOGETHER = 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_KIND = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

Edit = Callable[[list[bytes], int | None], list[bytes]]


def found_runs(docs: DataFrame, power: int = 4, least: int = 6, edit: Edit | None = None) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed), one for each row of docs.

    `runs` are in order of start, then period. `collapsed` has the words, joined by one space, without those that
    any run holds after its first q words. `edit` changes a document's words first; it gets them with the doc_id.
    """
    if power < 2 or least < 3:
        raise ValueError("a run repeats its period at least twice, and has three words or more")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_found(power, least, edit), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """Rows (doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256).

    start, length and period are those of the longest run; ties go to the smallest start, then period.
    """
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS s, -r.period AS p)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    length, period = F.col("best.length"), -F.col("best.p")
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(1000 * best.length) div (-best.p)").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _found(power: int, least: int, edit: Edit | None):
    def run(batches):
        for batch in batches:
            raw, at = bytes_of(batch.column("text"))
            names = batch.column("doc_id")
            for i, j in text_groups(at, TOGETHER):
                texts = [raw[at[k] : at[k + 1]].tobytes() for k in range(i, j)]
                if edit is not None:
                    for k, name in enumerate(names.slice(i, j - i).to_pylist()):
                        words = texts[k].split()
                        changed = edit(words, name)
                        if changed is not words:
                            texts[k] = b" ".join(changed)
                ends = np.cumsum([0] + [len(t) for t in texts])
                words = Words(np.frombuffer(b"".join(texts), np.uint8), ends)
                every = runs_of(words.hashes, words.first, power, least)
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(i, j - i),
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.array([[{"start": s, "length": n, "period": q} for s, n, q in own] for own in every], _KIND),
                        pa.array([_collapsed(t.split(), own) for t, own in zip(texts, every, strict=True)], pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def _collapsed(words: list[bytes], own: list[tuple[int, int, int]]) -> bytes:
    if own:
        stays = np.ones(len(words), bool)
        for start, length, period in own:
            stays[start + period : start + length] = False
        words = [words[k] for k in np.flatnonzero(stays).tolist()]
    return b" ".join(words)


def runs_of(hashes: np.ndarray, first: np.ndarray, power: int, least: int) -> list[list[tuple[int, int, int]]]:
    """Each document's runs (start, length, period); document k has the words from first[k] to first[k + 1]."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(first) - 1)]
    for lo, hi in _windows(hashes, first, power, least):
        k = int(np.searchsorted(first, lo, "right")) - 1
        begin, end = int(first[k]), int(first[k + 1])
        own = hashes[begin:end]
        ends: dict[int, int] = {}
        for i, d in squares(hashes[lo:hi].tolist(), power):
            i += lo - begin
            if i < ends.get(d, 0):
                continue
            start, stop = _extent(own, i, d)
            ends[d] = stop
            if stop - start >= max(least, power * d):
                out[k].append((start, stop - start, d))
    for own_runs in out:
        own_runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _windows(hashes: np.ndarray, first: np.ndarray, power: int, least: int) -> Iterator[tuple[int, int]]:
    """Stretches of words, each within a document, outside of which no run lies."""
    n = len(hashes)
    if n < 3:
        return
    of = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    pairs = shingles(hashes ^ mix(of + np.uint64(1)), 2)  # equal pairs of different documents differ
    order = np.argsort(pairs, kind="stable")
    same = np.flatnonzero(pairs[order[1:]] == pairs[order[:-1]])
    distance = np.zeros(n, np.int64)  # from a pair to the one before that equals it; 0 for none
    distance[order[same + 1]] = order[same + 1] - order[same]
    change = np.zeros(n + 1, np.int64)
    most, reach = int(distance.max()), 1
    while True:
        small = reach // 2 + 1  # periods from small to reach
        near = (distance > 0) & (distance <= reach)
        edges = np.flatnonzero(np.diff(near.astype(np.int8), prepend=0, append=0))
        begins, stops = edges[::2], edges[1::2]
        long = stops - begins >= max((power - 1) * small - 1, least - 1 - reach, 1)
        starts = np.maximum(begins[long] - reach, first[of[begins[long]].astype(np.int64)])
        np.add.at(change, starts, 1)
        np.add.at(change, np.minimum(stops[long] + 1, n), -1)
        if reach >= most:
            break
        reach *= 2
    covered = np.cumsum(change[:-1]) > 0
    inner = first[(first > 0) & (first < n)]
    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
    for lo, hi in edges.reshape(-1, 2).tolist():  # neighbouring documents' stretches may touch
        cuts = inner[np.searchsorted(inner, lo, "right") : np.searchsorted(inner, hi)].tolist()
        yield from zip([lo, *cuts], [*cuts, hi], strict=True)


def _extent(own: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The longest stretch [start, stop) around word i in which words d apart are the same; i - d equals i."""
    stop, step = i + 1, 64
    while stop < len(own):
        unlike = np.flatnonzero(own[stop : stop + step] != own[stop - d : min(stop + step, len(own)) - d])
        if len(unlike):
            stop += int(unlike[0])
            break
        stop, step = min(stop + step, len(own)), 2 * step
    start, step = i, 64  # words from start on equal those d before them
    while start > d:
        lo = max(d, start - step)
        unlike = np.flatnonzero(own[lo:start] != own[lo - d : start - d])
        if len(unlike):
            start = lo + int(unlike[-1]) + 1
            break
        start, step = lo, 2 * step
    return start - d, stop


def squares(text: list[int], power: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, d): the stretch that ends with word i has smallest period d and power * d words or more.

    At least the first such end of each run is given.
    """
    length, link, moves = [0, 0], [0, 0], [{}, {}]  # state 1 is the empty string, 0 is none
    up, left, right, last = [0, 0], [0, 0], [0, 0], [-1, -1]  # splay trees; `last` counts at their roots

    def splay(x: int) -> None:
        """Make x the root of its splay tree; the root's parent is the path above."""
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                turn(y if (left[z] == y) == (left[y] == x) else x)
                last[x] = last[z]
            else:
                last[x] = last[y]
            turn(x)
            y = up[x]

    def turn(x: int) -> None:
        y = up[x]
        z = up[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y], up[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    now, rest = 1, power - 1
    for i, word in enumerate(text):
        new = len(length)
        length.append(length[now] + 1)
        link.append(1)
        moves.append({})
        up.append(0)
        left.append(0)
        right.append(0)
        last.append(-1)
        p = now
        while p and word not in moves[p]:
            moves[p][word] = new
            p = link[p]
        if p:
            q = moves[p][word]
            if length[q] != length[p] + 1:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                moves.append(moves[q].copy())
                splay(q)  # cut q from what is above it; the copy comes between, with the same last end
                a = left[q]
                if a:
                    up[a], last[a], left[q] = up[q], last[q], 0
                up.append(link[q])
                left.append(0)
                right.append(0)
                last.append(last[q])
                up[q] = link[q] = copy
                while p and moves[p].get(word) == q:
                    moves[p][word] = copy
                    p = link[p]
                q = copy
            link[new] = q
        up[new] = link[new]
        now = x = new
        below = 0
        while x:
            splay(x)
            end = last[x]
            if end >= 0 and length[x] >= rest * (i - end):
                yield i, i - end
            a = right[x]
            if a:
                last[a] = end
            right[x] = below
            below, x = x, up[x]
        last[below] = i
