"""Ordered child lines folded into one delimited text per parent.

Lists are whole. A list is folded in two levels: lines that are near each other in the order (a slice)
become one text, then the texts of a parent's slices are joined in order. Slices are ranges of whole
line numbers or days, or, for other orders, ranges of parent and order (see `ranges`), so a parent with very many lines is folded by many tasks, and the second level
moves one text per slice. A whole list is one value, so one task holds it, several times, and it cannot have more
than the 2 GB of any value; `huge` keeps the number of copies down. A `width`, for a sink column that has one, clips every piece on the way; the
result is the same as clipping the whole list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitflow.functions.stamps import stamp_text
from visitflow.functions.text import clip, escape_markup
from visitflow.operators import ranges
from visitflow.operators.cohort import left_to_many

#: Line numbers in a slice.
SLICE = 256
#: Days in a slice of lists ordered by dates.
DAYS = 8
#: Tasks that finished lists are dealt to, at most; up to so many, Spark writes rows to the shuffle without holding them.
DEALT = 200
#: Sampled lines of a parent from which on its list is folded apart from those of others.
BUSY = 8
_SLICE, _PIECE = "_slice", "_piece"


def _slice(df: DataFrame, column: str) -> Column | None:
    """A value that is the same for neighbouring values of the column and grows with it, if its kind has one."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(column) / SLICE)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(column)
    if isinstance(kind, T.DateType):
        return F.floor(F.unix_date(column) / DAYS)
    return None


def _clipped(text: Column, width: int | None) -> Column:
    return text if width is None else clip(text, width)


def _joined(order: Sequence[Column], item: Column, sep: str, width: int | None, trailing: bool = False) -> Column:
    """Aggregate: items in order, joined; null items vanish, no item at all gives null.

    A list may be a good part of a task's memory, so the text is made once: fields of an array are taken without
    a copy and `concat_ws` knows its size beforehand, where `transform` copies each item and `array_join` doubles a buffer.
    """
    named = [c.alias(f"o{i}") for i, c in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.when(item.isNotNull(), F.struct(*named, item.alias("item")))))
    text = F.concat_ws(sep, rows.getField("item"), *[F.lit("")] * trailing)
    return F.when(F.size(rows) > 0, _clipped(text, width))


def _plain(kind: T.DataType) -> bool:
    """Equal values of the kind have equal hashes, which texts with a collation have not."""
    return isinstance(kind, T.AtomicType) and (not isinstance(kind, T.StringType) or kind.isUTF8BinaryCollation())


def _busy(lines: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> Column | None:
    """True for the lines of parents that have about a `BUSY / (ranges.SAMPLED * n)`-th of all lines or more, if any has.

    The sample is as in `ranges.borders`. A parent goes by a hash of its key, so all of its lines get the same answer.
    """
    if not all(_plain(lines.schema[k].dataType) for k in keys):
        return None
    key, each = F.xxhash64(*keys), F.xxhash64(*keys, *order)
    sampled = lines.groupBy(F.pmod(each, F.lit(ranges.SAMPLED * n)).alias("_class")).agg(F.min_by(key, each).alias("_key"))
    often = sampled.groupBy("_key").count().filter(F.col("count") >= BUSY)
    found = [r["_key"] for r in often.select("_key").collect()]  # SAMPLED * n / BUSY at most
    return key.isin(sorted(found)) if found else None


def _dealt(lists: DataFrame, keys: Sequence[str], name: str, n: int) -> DataFrame:
    """Finished lists in other tasks than those that folded them, the longest of a task at its end.

    A file writer keeps several copies of the first values of a file, of later ones few.
    """
    n = min(n, DEALT)
    dealt = lists.repartitionById(n, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
    return dealt.sortWithinPartitions(F.octet_length(name))


def _folded(
    lines: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    item: Column,
    name: str,
    sep: str,
    trailing: bool,
    width: int | None,
    huge: bool = False,
) -> DataFrame:
    columns = [F.col(c) for c in order]
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = _slice(lines, order[0])
    if near is None:
        cuts = ranges.borders(lines, [*keys, *order], n)
        sliced = ranges.with_range(lines, [*keys, *order], cuts, _SLICE)
    else:
        sliced = lines.withColumn(_SLICE, near)

    def lists(some: DataFrame) -> DataFrame:
        pieces = some.groupBy(*keys, _SLICE).agg(
            _joined(columns, item, sep, width).alias(_PIECE)
        )
        whole = _joined([F.col(_SLICE)], F.col(_PIECE), sep, width, trailing)
        return pieces.groupBy(*keys).agg(whole.alias(name))

    if not huge:
        return lists(sliced)
    busy = _busy(lines, keys, order, n)
    apart = lists(sliced) if busy is None else lists(sliced.filter(busy)).union(lists(sliced.filter(~busy)))
    return _dealt(apart, keys, name, n)


def enumerate_lines(
    df: DataFrame,
    keys: Sequence[str],
    line: str,
    value: str,
    name: str,
    width: int | None = None,
    sep: str = "|",
    trailing: bool = True,
    nulls: str = "empty",
    escape: bool = True,
    unique_lines: bool = False,
    huge: bool = False,
) -> DataFrame:
    """One row per parent: its lines joined in line order, as a whole or its first `width` characters.

    `nulls` is "empty" (a null line is an empty item) or "skip" (it leaves no trace; a parent
    with only null lines gets null). Of several values on one line the greatest counts; pass
    `unique_lines=True` when lines are known to be unique, which saves an exchange. Pass `huge=True`
    when a list may fill a good part of a task's memory: lists take one more exchange, so that no task
    holds the lines of a list while it hands the list on.
    """
    keys = list(keys)
    # Clipping keeps the order of texts, so it may come before the greatest is taken.
    text = _clipped(F.col(value).cast("string"), width)
    lines = df.select(*keys, F.col(line).alias("_line"), text.alias("_value"))
    if not unique_lines:
        lines = lines.groupBy(*keys, "_line").agg(F.max("_value").alias("_value"))
    if nulls == "empty":
        lines = lines.withColumn("_value", F.coalesce("_value", F.lit("")))
    item = _clipped(escape_markup("_value"), width) if escape else F.col("_value")
    return _folded(lines, keys, ["_line"], item, name, sep, trailing, width, huge)


def enumerate_distinct(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    value: str,
    name: str,
    width: int | None = None,
    sep: str = "|",
    escape: bool = True,
) -> DataFrame:
    """Like `enumerate_lines` over the distinct (`by`, value) pairs, ordered by them, null first."""
    keys, by = list(keys), list(by)
    text = _clipped(F.col(value).cast("string"), width)
    pairs = df.select(*keys, *by, text.alias("_value")).distinct()
    item = F.coalesce("_value", F.lit(""))
    if escape:
        item = _clipped(escape_markup(item), width)
    return _folded(pairs, keys, [*by, "_value"], item, name, sep, True, width)


def attach_lines(
    parents: DataFrame,
    child: DataFrame,
    on: str,
    lookup: DataFrame | None = None,
    lookup_on: str | None = None,
) -> DataFrame:
    """Lines of each distinct parent; a parent without lines keeps one row of nulls."""
    if lookup is not None:
        child = child.join(lookup, lookup_on, "left")
    return left_to_many(parents.select(on).distinct(), child, on)


def measure_history(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    measure: str,
    names: dict[str, tuple[str, str]],
    width: int | None = None,
    missing: str = "NA",
) -> DataFrame:
    """Parallel lists per measure: values and their minute stamps, one item per recorded time.

    `names` maps a measure to its (values, stamps) column names. Every group with any row gets an
    output row. The lists carry no trailing separator.
    """
    keys = list(keys)
    text = _clipped(F.coalesce(F.col(value).cast("string"), F.lit(missing)), width)
    points = (
        df.withColumn("_value", text).groupBy(*keys, measure, time).agg(F.max("_value").alias("_value"))
    )
    items = {"v": escape_markup("_value"), "t": stamp_text(time, "minute", blank=False)}
    pieces = points.groupBy(*keys, measure, _slice(points, time).alias(_SLICE)).agg(
        *[_joined([F.col(time)], item, "|", width).alias(f"{_PIECE}_{k}") for k, item in items.items()]
    )
    lists = []
    for code, both in names.items():
        for k, name in zip(items, both, strict=True):
            mine = F.when(F.col(measure) == code, F.col(f"{_PIECE}_{k}"))
            lists.append(_joined([F.col(_SLICE)], mine, "|", width).alias(name))
    return pieces.groupBy(*keys).agg(*lists)
