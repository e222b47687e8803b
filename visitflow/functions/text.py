"""Text rules of the flat sinks: clipping, quoting, delimiter safety, escaping and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, width: int) -> Column:
    return F.substring(_col(c).cast("string"), 1, width)


def blank(c, width: int) -> Column:
    """Clipped text with nulls as ''."""
    return F.coalesce(clip(c, width), F.lit(""))


def non_empty(c) -> Column:
    """True for text with something besides trailing blanks; null counts as empty."""
    return F.length(F.rtrim(_col(c))) > 0


def comma_safe(c, width: int) -> Column:
    return F.coalesce(clip(F.replace(_col(c), F.lit(","), F.lit("^")), width), F.lit(""))


def sanitize_list(c, width: int, strip_last: bool = True) -> Column:
    """Delimiter-safe list: drop the last character, clip, turn commas into ^, null into ''."""
    text = _col(c)
    if strip_last:
        kept = F.length(F.rtrim(text)) - 1
        text = F.substring(text, F.lit(1), kept)
    return comma_safe(clip(text, width), width)


def quote_list(c, width: int) -> Column:
    """Text in quotes, without trailing blanks, clipped; null becomes |."""
    text = F.concat(F.lit('"'), F.rtrim(_col(c)), F.lit('"'))
    return F.coalesce(clip(text, width), F.lit("|"))


def clip_list(c, width: int) -> Column:
    """Text without trailing blanks, clipped; null becomes |."""
    return F.coalesce(clip(F.rtrim(_col(c)), width), F.lit("|"))


def escape_markup(c) -> Column:
    """Markup entities for &, <, > and carriage return."""
    text = F.replace(_col(c), F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("<"), F.lit("&lt;"))
    text = F.replace(text, F.lit(">"), F.lit("&gt;"))
    return F.replace(text, F.lit("\r"), F.lit("&#x0D;"))


def pseudonym(c, width: int) -> Column:
    """Upper-case SHA-256 hex of the id's first `width` characters; null becomes ''."""
    digest = F.upper(F.sha2(clip(c, width), 256))
    return F.coalesce(digest, F.lit(""))
