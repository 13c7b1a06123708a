"""Object keys: parsing, naming of outputs, sharding, metadata maps. Everything is a column expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels of the pages that one photograph can give: the whole, the left and the right page.
LABELS = ("", "A", "B")
IMAGE_EXTENSIONS = r"(?i)\.(jpe?g|png|tiff?)$"
METADATA_LIMIT = 512


def basename(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def stem(key: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(basename(key), r"(?<=.)\.[^.]*$", "")


def root(key: Column) -> Column:
    """The whole key without its last extension."""
    return F.regexp_replace(key, r"(?<=[^/])\.[^./]*$", "")


def crop_key(key: Column, label: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), root(key), label, F.lit(".jpg"))


def coord_key(key: Column, label: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), root(key), label, F.lit(".json"))


def dashed_key(key: Column, label: Column, prefix: str = "") -> Column:
    """The older style: base name only, the label after a dash."""
    return F.concat(F.lit(prefix), stem(key), F.when(label != "", F.concat(F.lit("-"), label)).otherwise(""), F.lit(".jpg"))


def artefact_name(kind: Column, key: Column) -> Column:
    """The file name of a downloaded artefact: that of its key, or its kind; the known kinds get their extension where it is missing."""
    name = F.when(F.coalesce(key, F.lit("")) == "", F.concat(F.lit("artifact_"), kind)).otherwise(basename(key))
    extension = F.when(kind == "json", ".json").when(kind == "markdown", ".md").when(kind == "tables_zip", ".zip").otherwise("")
    return F.when(F.endswith(name, extension), name).otherwise(F.concat(name, extension))


def expected_keys(key: Column, prefix: str = "") -> Column:
    """Every crop key that a source may have led to, as an array."""
    return F.array(*[crop_key(key, F.lit(label), prefix) for label in LABELS])


def normalize_prefix(prefix: Column, separator: str = "-") -> Column:
    return F.regexp_replace(prefix, f"(?:{re.escape(separator)})+$", "") if separator else prefix


def job_title(prefix: Column, strip: str = "", separator: str = "-") -> Column:
    """The prefix without a configured beginning and one separator at its end."""
    out = F.when(prefix.startswith(strip), F.substring(prefix, len(strip) + 1, 1 << 20)).otherwise(prefix) if strip else prefix
    return F.regexp_replace(out, f"{re.escape(separator)}$", "")


def volume_of(name: Column, separator: str = "-") -> Column:
    return F.substring_index(name, separator, 1)


def store_uri(uri: Column, scheme: str = "s3") -> Column:
    """struct<bucket, prefix>; anything but ``scheme://bucket[/prefix]`` raises."""
    pattern = f"^{scheme}://([^/]+)/?(.*)$"
    ok = F.coalesce(uri.rlike(f"^{scheme}://[^/]"), F.lit(False))
    part = lambda i: F.when(ok, F.regexp_extract(uri, pattern, i)).otherwise(F.raise_error(F.concat(F.lit("not an object-store address: "), F.coalesce(uri, F.lit("null")))))
    return F.struct(part(1).alias("bucket"), part(2).alias("prefix"))


def is_image(key: Column) -> Column:
    return key.rlike(IMAGE_EXTENSIONS)


def in_shard(key: Column, index: int, shards: int) -> Column:
    """Whether a key is dealt to this shard by its CRC-32; with one shard or none all are."""
    return F.lit(True) if shards <= 1 else shard(key, shards) == index


def shard(key: Column, shards: int) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(shards)).cast("int")


def parse_shard(spec: str) -> tuple[int, int]:
    """'i/n' with 0 <= i < n."""
    m = re.fullmatch(r"\s*(\d+)\s*/\s*(\d+)\s*", spec)
    if not m or not 0 <= int(m[1]) < int(m[2]):
        raise ValueError(f"a shard is written i/n with 0 <= i < n, not {spec!r}")
    return int(m[1]), int(m[2])


def parse_rect(text: Column) -> Column:
    """struct<x,y,w,h> of 'rect:x=..,y=..,w=..,h=..'; null where a part is missing."""
    parts = F.str_to_map(F.regexp_replace(text, "^rect:", ""), F.lit(","), F.lit("="))
    return F.struct(*[parts[c].try_cast("double").alias(c) for c in ("x", "y", "w", "h")])


# ---------------------------------------------------------------- metadata maps
def _ascii(value: Column) -> Column:
    return F.left(F.regexp_replace(value, r"[^\x00-\x7F]", ""), F.lit(METADATA_LIMIT))


def encode_metadata(record: dict[str, Column], decimals: dict[str, int]) -> Column:
    """A string map of a record: ASCII only, of limited length, numbers with fixed decimals, lists joined by commas."""
    pairs = []
    for name, value in record.items():
        said = F.format_string(f"%.{decimals[name]}f", value.cast("double")) if name in decimals else value.cast("string")
        pairs += [F.lit(f"page-{name}"), _ascii(F.coalesce(said, F.lit("")))]
    return F.create_map(*pairs)


def decode_metadata(meta: Column) -> Column:
    """The record that a string map holds.

    Confidences that are missing or no numbers are 0, other missing numbers null; reasons are split at
    commas without blanks; without a blank verdict the status is unknown."""
    number = lambda k: F.try_element_at(meta, F.lit(f"page-{k}")).try_cast("double")
    said = lambda k: F.try_element_at(meta, F.lit(f"page-{k}"))
    return F.struct(
        F.coalesce(said("label"), F.lit("")).alias("label"),
        F.coalesce(F.lower(said("blank")) == "true", F.lit(False)).alias("is_blank"),
        F.coalesce(F.lower(said("review")) == "true", F.lit(False)).alias("needs_review"),
        F.filter(F.split(F.coalesce(said("reasons"), F.lit("")), ","), lambda x: F.trim(x) != "").alias("review_reasons"),
        F.coalesce(number("blank_conf"), F.lit(0.0)).alias("blank_conf"),
        F.coalesce(number("orientation_conf"), F.lit(0.0)).alias("orientation_conf"),
        number("text_frac").alias("text_frac"),
        number("rotation").alias("rotation_deg"),
        F.coalesce(~F.map_contains_key(meta, "page-blank"), F.lit(True)).alias("status_unknown"),
    )
