"""Identifiers and hashes: pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_hash(value: Column, length: int = 12) -> Column:
    """Leading hexadecimal digits of a SHA-1 digest; a null counts as ''."""
    return F.substring(F.sha1(F.coalesce(value, F.lit(""))), 1, length)


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor ''."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def canonical_path(path: Column) -> Column:
    """One form of a path, whether it came percent-encoded or not, so that both hash alike."""
    return F.when(path.rlike("%[0-9A-Fa-f]{2}"), F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def parent_id(path: Column, file: Column) -> Column:
    return short_hash(first_filled(canonical_path(path), file, F.lit("unknown")), 16)


def text_chunk_id(parent: Column, ordinal: Column, text: Column) -> Column:
    return F.concat_ws("_", F.lit("txt"), parent, F.coalesce(ordinal.cast("string"), F.lit("0")), short_hash(text))


def diagram_chunk_id(parent: Column, image_hash: Column) -> Column:
    return F.concat_ws("_", F.lit("dgm"), parent, F.substring(image_hash, 1, 16))


def table_chunk_id(parent: Column, table_index: Column) -> Column:
    return F.concat_ws("_", F.lit("tbl"), parent, table_index.cast("string"))


def table_row_chunk_id(parent: Column, table_index: Column, row_index: Column) -> Column:
    return F.concat_ws("_", F.lit("trow"), parent, table_index.cast("string"), row_index.cast("string"))


def summary_chunk_id(parent: Column) -> Column:
    return F.concat_ws("_", F.lit("sum"), parent)


def safe_int(value: Column) -> Column:
    return F.nullif(F.trim(value.cast("string")), F.lit("")).try_cast("int")


def safe_str(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def image_hash(encoded: Column) -> Column:
    """SHA-256 of the decoded picture; of the text itself where it isn't base64; 'noimage' for none."""
    raw = F.try_to_binary(encoded, F.lit("base64"))
    return F.when(F.coalesce(F.length(encoded), F.lit(0)) == 0, "noimage").otherwise(F.sha2(F.coalesce(raw, encoded.cast("binary")), 256))


def phash_distance(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes in hexadecimal; 64 where either isn't one."""
    half = lambda c, at: F.conv(F.substring(c, at, 8), 16, 10).cast("bigint")
    bits = sum((F.bit_count(half(a, at).bitwiseXOR(half(b, at))) for at in (1, 9)), F.lit(0))
    sound = a.rlike("^[0-9a-fA-F]{16}$") & b.rlike("^[0-9a-fA-F]{16}$")
    return F.when(sound, bits).otherwise(64).cast("int")


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, rounded up."""
    return F.call_function("div", F.coalesce(F.length(text), F.lit(0)) + 3, F.lit(4)).cast("bigint")
