"""Column naming convention, for names on the driver and for values in a column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accented Vietnamese letters by their plain letter.
ACCENTED = {
    "a": "àáạảãâầấậẩẫăằắặẳẵ",
    "e": "èéẹẻẽêềếệểễ",
    "i": "ìíịỉĩ",
    "o": "òóọỏõôồốộổỗơờớợởỡ",
    "u": "ùúụủũưừứựửữ",
    "y": "ỳýỵỷỹ",
    "d": "đ",
}
ACCENT_FROM = "".join(v + v.upper() for v in ACCENTED.values())
ACCENT_TO = "".join(k * len(v) + k.upper() * len(v) for k, v in ACCENTED.items())

# The rules in order, as (Python pattern, Java pattern, replacement). Python's
# Unicode \w is letters, numbers and underscore, spelled out for Java. The comparison signs
# come first, so ">=" ends up as "gt_". The digit test precedes the underscore strip.
NAME_RULES = (
    (r">", r">", "gt_"),
    (r"<", r"<", "lt_"),
    (r"[^\w]+", r"[^\p{L}\p{N}_]+", "_"),
    (r"^(?=\d)", r"^(?=\p{Nd})", "C_"),
    (r"^_|_$", r"^_|_$", ""),
    (r"_{2,}", r"_{2,}", "_"),
)

_FOLD = str.maketrans(ACCENT_FROM, ACCENT_TO)


def fold_accents(col: Column | str) -> Column:
    """Vietnamese letters of a column to plain ASCII, both cases. Pure ASCII passes untouched."""
    text = F.col(col) if isinstance(col, str) else col
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(F.translate(text, ACCENT_FROM, ACCENT_TO))


def normalize_name(name: str) -> str:
    """One column name by the naming convention."""
    text = str(name)
    for pattern, _, replacement in NAME_RULES:
        text = re.sub(pattern, replacement, text)
    return text.translate(_FOLD).upper()


def normalize_values(col: Column | str) -> Column:
    """The naming convention applied to the values of a column.

    Accents are folded first: letters stay letters, so the order of that step is free.
    """
    out = fold_accents(col)
    for _, pattern, replacement in NAME_RULES:
        if re.escape(pattern) == pattern:
            out = F.replace(out, F.lit(pattern), F.lit(replacement))
        else:
            out = F.regexp_replace(out, pattern, replacement)
    return F.upper(out)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns; two names that become one are an error."""
    names = [normalize_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        sources = {n: [c for c, m in zip(df.columns, names) if m == n] for n in clashes}
        raise ValueError(f"columns become equal after normalising: {sources}")
    return df.toDF(*names)
