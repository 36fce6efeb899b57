"""Small column and column-name helpers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip_aggregate_name(df: DataFrame, fn: str) -> DataFrame:
    """Rename ``fn(x)`` columns to ``x``; all other columns keep their name."""
    pattern = re.compile(rf"^{re.escape(fn)}\((.*)\)$")
    return df.toDF(*[m.group(1) if (m := pattern.match(c)) else c for c in df.columns])


def convert_units(df: DataFrame, mapping: Mapping[str, str], factor: float) -> DataFrame:
    """Replace each per-unit column ``src`` by ``dst = src / factor``."""
    return df.withColumns({dst: F.col(src) / F.lit(factor) for src, dst in mapping.items()}).drop(
        *[src for src, dst in mapping.items() if src != dst]
    )


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns new names by position."""
    return df.toDF(*names)


def nan_to_null(name: str, dtype: T.DataType) -> Column:
    """The column with NaN read as missing; columns without NaN are left alone."""
    c = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(c), F.lit(None)).otherwise(c)
    return c


# the last extension of a name; dots at the start of a name begin none
_EXTENSION = r"(?s)^(.*[^/.]\.*)\.[^./]*$"


def index_from_object_key(key: Column) -> Column:
    """Index name of a URL-encoded object key: decoded, last extension removed."""
    return F.regexp_replace(F.url_decode(key), _EXTENSION, "$1")


def index_from_file_path(path: Column, root: str | None = None) -> Column:
    """Index name of a ``_metadata.file_path`` value, relative to ``root``.

    File paths are percent-encoded but, unlike object keys in events, a plus
    sign in them is a plus sign.
    """
    if root is not None:
        prefix = re.sub(r"^[a-z0-9]+:/*", "/", root.rstrip("/"))
        path = F.regexp_replace(path, "^[a-z0-9]+:/*", "/")
        decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
        relative = F.when(
            F.startswith(decoded, F.lit(prefix + "/")), F.substring(decoded, len(prefix) + 2, 1 << 30)
        ).otherwise(decoded)
        return F.regexp_replace(relative, _EXTENSION, "$1")
    return index_from_object_key(F.replace(path, F.lit("+"), F.lit("%2B")))
