"""Language names and codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.functions.text import as_column


def _lookup(c: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def language_code(name: Column | str) -> Column:
    """Language name in any case -> code; an unknown name gives null, which means no filter."""
    return _lookup(F.lower(as_column(name)), V.LANGUAGE_CODES)


def language_name(code: Column | str) -> Column:
    """Code -> language name; a missing or unknown code gives the default language."""
    return F.coalesce(_lookup(as_column(code), V.LANGUAGE_NAMES), F.lit(V.DEFAULT_LANGUAGE_NAME))


def require_language(name: str) -> str:
    """Code of a language name for a report; an unknown name is an error."""
    code = V.LANGUAGE_CODES.get(name.lower())
    if code is None:
        raise ValueError(f"'{name}' is not supported; use one of {sorted(V.LANGUAGE_CODES)}")
    return code
