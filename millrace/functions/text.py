"""Text and value functions: sizes, paths, JSON, base64, blanks, filters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIZE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB")  # fixed values, 1024 apart


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def human_size(col: Column | str, decimals: int = 2) -> Column:
    """Bytes as text such as ``1.50 KiB``; ties round to even."""
    size = _c(col).cast("double")
    last = len(SIZE_UNITS) - 1
    ladder = None
    for i, unit in enumerate(SIZE_UNITS):
        scaled = size / float(1024**i)
        text = F.concat(F.format_string(f"%.{decimals}f", F.bround(scaled, decimals)), F.lit(f" {unit}"))
        if i == last:
            return ladder.otherwise(text)
        small = size < float(1024 ** (i + 1))
        ladder = F.when(small, text) if ladder is None else ladder.when(small, text)
    raise AssertionError("unreachable")


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text and NaN become NULL in every column."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            changed[field.name] = F.nullif(F.col(field.name), F.lit(""))
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            changed[field.name] = F.when(~F.isnan(field.name), F.col(field.name))
    return df.withColumns(changed) if changed else df


def to_json_text(col: Column | str) -> Column:
    """Struct, map or array as JSON text."""
    return F.to_json(_c(col))


def base64_encode(col: Column | str) -> Column:
    """One line, without the breaks some Spark versions put after 76 characters."""
    return F.translate(F.base64(F.encode(_c(col), "UTF-8")), "\r\n", "")


def base64_decode(col: Column | str) -> Column:
    return F.decode(F.unbase64(_c(col)), "UTF-8")


def base_name(path: Column | str) -> Column:
    """Part after the last ``/``."""
    return F.substring_index(_c(path), "/", -1)


def parent_path(path: Column | str) -> Column:
    """Part before the last ``/``; ``.`` when there is none."""
    col = _c(path)
    cut = F.regexp_extract(col, r"^(.*)/[^/]*$", 1)
    return F.when(F.instr(col, "/") > 0, cut).otherwise(F.when(col.isNotNull(), "."))


def suffix(path: Column | str) -> Column:
    """Last extension in lower case without the dot; empty if there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"[^.]\.([^.]+)$", 1))


def stem(path: Column | str) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]+$", "")


def file_key(parent: Column | str, name: Column | str, mtime: Column | str) -> Column:
    """Display key of a file version: parent, name and ``yyyyMMddHHmmss``."""
    return F.concat(_c(parent), _c(name), F.date_format(_c(mtime), "yyyyMMddHHmmss"))


def name_matches(col: Column | str, pattern: str) -> Column:
    """``LIKE '%pattern%'``, or a regular expression when the pattern has ``^ $ [ ] +``.

    NULL does not match.
    """
    hit = _c(col).rlike(pattern) if re.search(r"[\^$\[\]+]", pattern) else _c(col).contains(pattern)
    return F.coalesce(hit, F.lit(False))


def remove_prefix(col: Column | str, prefix: str) -> Column:
    """Text without ``prefix`` at its start."""
    col = _c(col)
    return F.when(F.startswith(col, F.lit(prefix)), F.substring(col, F.lit(len(prefix) + 1), F.length(col))).otherwise(col)


def round_or_zero(col: Column | str, scale: int = 2) -> Column:
    return F.coalesce(F.round(_c(col), scale), F.lit(0))


def content_sha(col: Column | str, bits: int = 512) -> Column:
    """Native content hash of a text or binary column."""
    return F.sha2(_c(col), bits)


@F.pandas_udf(T.StringType())
def blake2b_hex(content):
    """BLAKE2b of whole byte strings, Arrow batches; there is no JVM expression for it."""
    import hashlib

    return content.map(lambda b: hashlib.blake2b(b).hexdigest() if b is not None else None)
