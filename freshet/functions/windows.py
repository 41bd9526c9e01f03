"""Character windows over a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.text import is_blank, strip


def _pattern(size: int, step: int) -> str:
    # The look-ahead captures one window, then one step is consumed. Possessive quantifiers never backtrack, so a
    # text of any length is cut in a single linear pass (a substring per window would rescan from the start).
    return rf"(?s)(?=(.{{1,{size}}}+)).{{1,{step}}}+"


def windows(text: Column, size: int, overlap: int) -> Column:
    """Array of windows of `size` code points, one every `size - overlap`, of the stripped text; no blank ones."""
    stripped = strip(text)
    if size <= 0:
        return F.filter(F.array(stripped), lambda w: w != "")
    step = max(1, size - overlap)
    cut = F.regexp_extract_all(stripped, F.lit(_pattern(size, step)), F.lit(1))
    return F.filter(cut, lambda w: ~is_blank(w))


def windows_by_column(text: Column, size: Column, overlap: Column) -> Column:
    """The same with size and overlap taken from columns."""
    stripped = strip(text)
    step = F.greatest(F.lit(1), size - overlap)
    pattern = F.concat(
        F.lit("(?s)(?=(.{1,"), size.cast("string"), F.lit("}+)).{1,"), step.cast("string"), F.lit("}+")
    )
    cut = F.when(size > 0, F.regexp_extract_all(stripped, pattern, F.lit(1))).otherwise(F.array(stripped))
    return F.filter(cut, lambda w: ~is_blank(w))
