"""Sparse rule ensemble for text quality: tree paths as rules, lasso weights, column expressions.

Each whole text is measured once (MEASURES). Boosted trees over the measures of labelled rows give
conjunctive rules, one for each path from a root; a logistic regression with an L1 penalty weights the
rules and drops most. What is left is one Spark column expression over the measures, so scoring is free
of Python code.

The fit uses at most MAX_LABELLED labelled rows, those with the smallest hashes of doc_id; labels, lang, source
and doc_id are never measured. Everything else covers all rows.

Defined cases: null and empty texts have all measures 0 and get a score like others. Labels that are
null or of unknown documents are not used. With no labelled row, one class only, or labels that no rule tells apart, the
score is the share of label 1 (0.5 without rows). Repeated rows are each scored; rows without doc_id too. Other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm import shared
from visitflow.llm.hashing import Words, bytes_of, mix, runs, text_groups

MAX_LABELLED = 20_000
MEASURES = (
    "chars", "words", "word_length", "distinct_words", "distinct_pairs", "top_word", "repeated_next",
    "lines", "words_a_line", "distinct_lines", "upper", "digits", "symbols", "marks", "bars", "beyond_ascii", "spaces",
)
_B = np.arange(256)
_CLASSES = np.stack(
    [
        (_B >= 65) & (_B <= 90),
        (_B >= 48) & (_B <= 57),
        np.isin(_B, list(b"#*$%&<>@^~=+\\/{}[]")),
        np.isin(_B, list(b"!?.,;:'\"()-")),
        _B == ord("|"),
        _B >= 128,
        (_B == 32) | ((_B >= 9) & (_B <= 13)),
        (_B < 128) | (_B >= 192),  # first bytes of characters
        _B == 10,
    ]
)


def measures(batches):
    """Arrow batches (doc_id, text) to (doc_id, one column for each of MEASURES)."""
    for batch in batches:
        raw, at = bytes_of(batch.column("text"))
        for i, j in text_groups(at):
            part, spots = raw[at[i] : at[j]], at[i : j + 1] - at[i]
            found = np.zeros((len(MEASURES), j - i))
            counts = []
            for kind in _CLASSES:
                sums = np.cumsum(kind[part], dtype=np.int64)
                sums = np.append(np.int64(0), sums)
                counts.append(sums[spots[1:]] - sums[spots[:-1]])
            upper, digits, symbols, marks, bars, beyond, spaces, chars, breaks = counts
            words = Words(part, spots)
            n = np.diff(words.first)
            letters = np.maximum(chars - spaces, 1)
            found[0], found[1], found[2] = chars, n, (chars - spaces) / np.maximum(n, 1)
            for k in np.flatnonzero(n).tolist():
                own = words.hashes[words.first[k] : words.first[k + 1]]
                once, often = np.unique(own, return_counts=True)
                found[3, k] = len(once) / len(own)
                found[4, k] = len(np.unique(runs(own, 2))) / max(1, len(own) - 1)
                found[5, k] = often.max() / len(own)
                found[6, k] = (own[1:] == own[:-1]).mean() if len(own) > 1 else 0
                lines = part[spots[k] : spots[k + 1]].tobytes().split(b"\n") if breaks[k] else [b""]
                full = [x for x in lines if x.strip()] if len(lines) > 1 else lines
                found[9, k] = len(set(full)) / max(1, len(full))
            found[7] = breaks + (chars > 0)
            found[8] = n / np.maximum(found[7], 1)
            for row, count in zip(range(10, 16), (upper, digits, symbols, marks, bars, beyond), strict=True):
                found[row] = count / letters
            found[16] = spaces / np.maximum(chars, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), *[pa.array(x) for x in found]], ["doc_id", *MEASURES]
            )


Rule = tuple[tuple[str, bool, float], ...]  # (measure, whether it must be greater, cutoff), all of which hold


def scored(docs: DataFrame, labels: DataFrame, usable: Column, target: str = "quality") -> DataFrame:
    """Rows (doc_id, measures, score) of all docs; the fit uses labels of rows for which `usable` holds."""
    measured = _measured(docs)
    return measured.withColumn("score", _fit(measured, labels, usable, target))


def accepted(docs: DataFrame, labels: DataFrame, usable: Column, target: str = "quality") -> DataFrame:
    """The rows of docs, as they are, whose score is 0.5 or more. Texts are measured as they pass, not joined."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    learnt = _chosen(_known(labels, target).where(usable).join(named, "doc_id")).select("doc_id").distinct()
    texts = docs.join(F.broadcast(learnt), "doc_id", "left_semi")  # MAX_LABELLED ids at most
    score = _fit(_measured(texts), labels, usable, target)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = "row " + docs.schema.simpleString() + "".join(f", {m} double" for m in MEASURES)
    return whole.mapInArrow(shared.released(_carrying), schema).where(score >= 0.5).select("row.*")


def _measured(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, " + ", ".join(f"{m} double" for m in MEASURES)
    return shared.stored(texts.mapInArrow(shared.released(measures), schema), "measures")


def _carrying(batches):
    for batch in batches:
        row, done = batch.column("row"), 0
        texts = pa.RecordBatch.from_arrays([row.field("doc_id"), row.field("text")], ["doc_id", "text"])
        for found in measures([texts]):
            own = row.slice(done, found.num_rows)
            yield pa.RecordBatch.from_arrays([own, *found.columns[1:]], ["row", *MEASURES])
            done += found.num_rows


def _known(labels: DataFrame, target: str) -> DataFrame:
    return labels.where(F.col(target).isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("_label")
    )


def _chosen(labelled: DataFrame) -> DataFrame:
    """The labelled rows that a fit uses."""
    return labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)


def _fit(measured: DataFrame, labels: DataFrame, usable: Column, target: str) -> Column:
    rows = _chosen(measured.where(usable).join(_known(labels, target), "doc_id")).select("_label", *MEASURES).collect()
    table = np.array([tuple(r) for r in rows], np.float64).reshape(len(rows), 1 + len(MEASURES))
    return expression(*fitted(table[:, 1:], table[:, 0] > 0))


def fitted(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 2e-4):
    """(intercept, [(weight, rule)]) for measures x and labels y."""
    rules = sorted(_rules(x, y, trees, depth)) if y.any() and not y.all() else []
    if not rules:
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return float(np.log(share / (1 - share))), []
    held = np.stack([_holds(rule, x) for rule in rules], 1)
    held, first = np.unique(held, axis=1, return_index=True)
    varied = (held.mean(0) > 0.001) & (held.mean(0) < 0.999)
    rules = [rules[k] for k in first[varied].tolist()]
    intercept, weights = _lasso(held[:, varied].astype(np.float64), y.astype(np.float64), penalty)
    return intercept, [(float(w), r) for w, r in zip(weights, rules, strict=True) if w != 0]


def expression(intercept: float, weighted: list[tuple[float, Rule]]) -> Column:
    """The score, between 0 and 1, as a column over the measures."""
    total = F.lit(intercept)
    for weight, rule in weighted:
        holds = F.lit(True)
        for name, above, cutoff in rule:
            holds = holds & ((F.col(name) > cutoff) if above else (F.col(name) <= cutoff))
        total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, above, cutoff in rule:
        column = x[:, MEASURES.index(name)]
        out &= column > cutoff if above else column <= cutoff
    return out


def _rules(x: np.ndarray, y: np.ndarray, trees: int, depth: int) -> set[Rule]:
    """Every path from a root of boosted trees; each tree sees half of the rows and two thirds of the measures."""
    chance = np.random.default_rng(7)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 33)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
    score, out = np.zeros(len(y)), set()
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-6)
        sample = chance.random(len(y)) < 0.5 if len(y) > 1000 else np.ones(len(y), bool)
        tried = np.sort(chance.permutation(x.shape[1])[: max(1, 2 * x.shape[1] // 3)])
        step = np.zeros(len(y))
        nodes: list[tuple[Rule, np.ndarray]] = [((), np.ones(len(y), bool))]
        for level in range(depth + 1):
            following = []
            for rule, inside in nodes:
                seen = inside & sample
                best = _split(binned, slope, bend, seen, tried, cuts) if level < depth else None
                if best is None:
                    step[inside] = slope[seen].sum() / (bend[seen].sum() + 1.0)
                    continue
                column, k = best
                for above in (False, True):
                    path = (*rule, (MEASURES[column], above, float(cuts[column][k])))
                    out.add(path)
                    following.append((path, inside & ((binned[:, column] > k) == above)))
            nodes = following
        score += 0.3 * np.clip(step, -4, 4)
    return out


def _split(binned, slope, bend, seen, tried, cuts):
    best, gain = None, 1e-6
    g, h = slope[seen], bend[seen]
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for column in tried.tolist():
        size = len(cuts[column]) + 1
        if size < 2:
            continue
        b = binned[seen, column]
        left_g = np.cumsum(np.bincount(b, g, size))[:-1]
        left_h = np.cumsum(np.bincount(b, h, size))[:-1]
        left_n = np.cumsum(np.bincount(b, minlength=size))[:-1]
        gains = left_g**2 / (left_h + 1.0) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1.0) - whole
        gains[(left_n < 5) | (len(g) - left_n < 5)] = 0
        k = int(gains.argmax())
        if gains[k] > gain:
            best, gain = (column, k), gains[k]
    return best


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on the weights, by accelerated proximal gradient steps."""
    middle = x.mean(0)
    x = x - middle
    wide = np.hstack([np.ones((len(x), 1)), x])
    rate = 4 / (np.linalg.norm(wide, 2) ** 2 / len(x))
    now = np.zeros(wide.shape[1])
    now[0] = np.log(y.mean() / (1 - y.mean()))
    ahead, pace = now, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(wide @ ahead, -30, 30)))
        new = ahead - rate * (wide.T @ (p - y)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        following = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / following * (new - now)
        now, pace = new, following
    return float(now[0] - middle @ now[1:]), now[1:]
