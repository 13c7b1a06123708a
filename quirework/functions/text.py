"""Measures of transcribed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeezed(text: Column) -> Column:
    """Without white space at the ends, and runs of it as one space."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def char_count(text: Column) -> Column:
    """Characters of the squeezed text: those that are no white space, and one for each gap between words."""
    return F.length(squeezed(text))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+"))


def lenient_records(text: Column, schema: str) -> Column:
    """Records of a JSON list: strict, else with escaped brackets and underscores restored, else pairs found by pattern.

    ``schema`` is an array of structs with string fields ``file`` and ``transcription``."""
    pattern = r'"file"\s*:\s*"([^"]*)"\s*,\s*"transcription"\s*:\s*"((?:[^"\\]|\\.)*)"'

    def by_pattern(text: Column) -> Column:
        names, texts = F.regexp_extract_all(text, F.lit(pattern), 1), F.regexp_extract_all(text, F.lit(pattern), 2)
        return F.zip_with(names, texts, lambda f, t: F.struct(f.alias("file"), t.alias("transcription")))

    # a column that is named twice is worked out twice: each reading stands in a list of one, and so does the text
    whole = lambda x: F.get(F.filter(F.array(x), lambda v: v.isNotNull() & ~F.exists(v, lambda r: r.isNull() | r["file"].isNull())), F.lit(0))
    restored = lambda t: F.regexp_replace(t, r"\\([\[\]_])", "$1")
    return F.transform(F.array(text), lambda t: F.coalesce(whole(F.from_json(t, schema)), whole(F.from_json(restored(t), schema)), by_pattern(t)))[0]


def first_kept(text: Column, kept: str, n: int) -> Column:
    """The first n characters of a class (as in [...]), null as empty; the text is read as far as the last of them."""
    head = F.regexp_extract(F.coalesce(text, F.lit("")), f"^(?:[^{kept}]*+[{kept}]){{0,{n}}}+", 0)
    return F.regexp_replace(head, f"[^{kept}]", "")
