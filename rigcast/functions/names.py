"""Name handling: unit numbers from file names, path decoding, header normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rigcast.constants import UNIT_STRIP_CHARS

_STRIP_CLASS = "[" + re.escape(UNIT_STRIP_CHARS).replace("/", "\\/") + "]"


def file_name(path: Column) -> Column:
    """Last component of a path."""
    return F.element_at(F.split(path, "/"), -1)


def decode_url_path(path: Column) -> Column:
    """Undo the URL encoding of ``_metadata.file_path`` (``%20`` for a blank)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def unit_from_name(name: Column) -> Column:
    """Unit number: strip the leading marker characters, take the text up to the
    first ``_`` or ``-``, keep its last four characters and read an integer.
    Anything unreadable gives null (the file is then rejected)."""
    stripped = F.regexp_replace(name, "^" + _STRIP_CLASS + "+", "")
    token = F.split(stripped, "[_-]").getItem(0)
    return F.right(token, F.lit(4)).try_cast("int")


def normalise_name(name: str, style: str = "upper") -> str:
    """Header normalisation. ``upper``: strip, blank -> ``_``, upper case.
    ``keep_case``: strip on the left only, blank -> ``_``, case kept."""
    if style == "upper":
        return name.strip().replace(" ", "_").upper()
    if style == "keep_case":
        return name.lstrip().replace(" ", "_")
    raise ValueError(f"unknown naming style {style!r}")


def normalise_names(names: list[str], style: str = "upper") -> list[str]:
    out = [normalise_name(n, style) for n in names]
    seen: dict[str, str] = {}
    for before, after in zip(names, out):
        key = after.lower()
        if key in seen and seen[key] != before:
            raise ValueError(
                f"columns {seen[key]!r} and {before!r} both normalise to {after!r}")
        seen[key] = before
    return out
