"""Ranges of an order over several columns, by borders that are computed once and are then part of the plan.

The borders come from a sample of fixed size: rows are put into a number of classes by hash, and of each class
the row with the smallest hash is taken, which is an aggregation over the ordered columns alone that combines
before the shuffle. They become literals, so a row's range is a plain column expression: the same whenever a
task is repeated, and nothing has to be stored for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled rows for each range.
SAMPLED = 24
#: Borders that a row is compared with one by one; more are compared in two steps.
TOGETHER = 32

Border = tuple[str | None, ...]


def borders(df: DataFrame, columns: Sequence[str], n: int) -> list[Border]:
    """Borders, as texts, that cut the rows into about n ranges of equal size in the order of the columns, nulls first."""
    if n < 2:
        return []
    each = F.xxhash64(*columns)
    row = F.struct(*columns)
    sample = df.select(*columns).groupBy(F.pmod(each, F.lit(SAMPLED * n)).alias("_class")).agg(F.min_by(row, each).alias("_row"))
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    found = [tuple(r) for r in sample.select("_row.*").sort(*columns).select(*texts).collect()]  # SAMPLED * n at most
    return list(dict.fromkeys(found[len(found) * k // n] for k in range(1, n) if len(found) * k // n > 0))


def _struct(values: Sequence[Column]) -> Column:
    return F.struct(*[v.alias(f"k{i}") for i, v in enumerate(values)])


def _literals(df: DataFrame, columns: Sequence[str], cuts: Sequence[Border]) -> Column:
    kinds = [df.schema[c].dataType for c in columns]
    return F.array(*[_struct([F.lit(v).cast(k) for v, k in zip(cut, kinds, strict=True)]) for cut in cuts])


def with_range(df: DataFrame, columns: Sequence[str], cuts: Sequence[Border], name: str) -> DataFrame:
    """Add the number of borders that a row is not before, which grows with the columns."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    key = _struct([F.col(c) for c in columns])

    def passed(some: Column) -> Column:
        return F.size(F.filter(some, lambda border: border <= key))

    if len(cuts) <= TOGETHER:
        return df.withColumn(name, passed(_literals(df, columns, cuts)))
    step = int(len(cuts) ** 0.5) + 1
    parts = [cuts[k : k + step] for k in range(0, len(cuts), step)]
    firsts = _literals(df, columns, [p[0] for p in parts])
    inner = F.array(*[_literals(df, columns, p) for p in parts])
    coarse = df.withColumn("_coarse", passed(firsts))
    fine = passed(F.element_at(inner, F.greatest(F.col("_coarse"), F.lit(1))))
    return coarse.withColumn(name, F.when(F.col("_coarse") == 0, 0).otherwise((F.col("_coarse") - 1) * step + fine)).drop("_coarse")


def groups_cut(df: DataFrame, keys: Sequence[str], cuts: Sequence[Border]) -> DataFrame:
    """The keys of the groups that a border may lie in: as many rows as borders, at most."""
    found = list(dict.fromkeys(cut[: len(keys)] for cut in cuts))
    texts = df.sparkSession.createDataFrame(found, ", ".join(f"_t{i} string" for i in range(len(keys))))
    return texts.select(*[F.col(f"_t{i}").cast(df.schema[k].dataType).alias(f"_s_{k}") for i, k in enumerate(keys)])
