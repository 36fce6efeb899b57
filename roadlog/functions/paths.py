"""Parts of a JSON document by the paths of its members."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Spelled(str):
    """A number as it is written."""


def _text(value) -> str:
    if isinstance(value, _Spelled):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_text(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_text, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def _expression(pattern: str) -> str:
    return ".*".join(map(re.escape, pattern.split("*")))


class PathFilter:
    """Which members of a document stay.

    A pattern is a dotted path in which ``*`` stands for any characters, dots too.  It
    matches a member and all below it.  A member stays if an include matches it (none
    given: all match) and no exclude does; objects on the way to it stay around it.
    Elements of a list have the path of the list.
    """

    def __init__(self, includes: Sequence[str] = (), excludes: Sequence[str] = ()) -> None:
        def whole(patterns):
            return re.compile("|".join(f"(?:{_expression(p)})(?:\\..*)?" for p in patterns) or r"(?!)", re.S)

        self._all = not includes
        self._includes, self._excludes = whole(includes), whole(excludes)
        # the first members of includes, up to a star: below others nothing can match
        self._heads = [tuple(p.split("*")[0].split(".")[:-1] if "*" in p else p.split(".")) for p in includes]

    def _leads_on(self, path: tuple) -> bool:
        return any(path[: len(h)] == h[: len(path)] for h in self._heads)

    def kept(self, value, path: tuple = (), inside: bool = False):
        """The value without what goes; None and False when nothing of it stays."""
        if isinstance(value, dict):
            members = {}
            for name, member in value.items():
                own = (*path, name)
                dotted = ".".join(own)
                if self._excludes.fullmatch(dotted):
                    continue
                matched = inside or self._all or bool(self._includes.fullmatch(dotted))
                if not matched and not self._leads_on(own):
                    continue
                found, stays = self.kept(member, own, matched)
                if stays:
                    members[name] = found
            return members, inside or self._all or bool(members)
        if isinstance(value, list):
            found = [self.kept(v, path, inside) for v in value]
            return [v for v, stays in found if stays], inside or self._all or any(stays for _, stays in found)
        return value, inside or self._all

    def __call__(self, text: str | None) -> str | None:
        if text is None:
            return None
        value = json.loads(text, parse_int=_Spelled, parse_float=_Spelled, parse_constant=_Spelled)
        return _text(self.kept(value)[0]) if isinstance(value, dict) else text


def project_paths(source: Column, includes: Sequence[str] = (), excludes: Sequence[str] = ()) -> Column:
    """JSON text of a document with only some of its members (:class:`PathFilter`).

    Members keep their order and numbers their spelling; texts that are no objects stay
    as they are, null stays null, and text that is no JSON fails.
    """
    wanted = PathFilter(tuple(includes), tuple(excludes))

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([wanted(t) for t in texts], dtype=object)

    return run(source)
