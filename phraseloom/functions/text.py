"""Text expressions. All are built-in column functions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from phraseloom.functions import fixed_values as V

# The characters Python's str.split() and re treat as white space; plain \s and trim() miss some.
_SPACE = r"[\s\x1c-\x1f]"
_VISIBLE = r"(?U)[^\s\x1c-\x1f]"
_RUN = rf"(?U){_SPACE}+"
# The look-behind lets only the first character of a run start a match, so that a long inner run
# costs linear time.
_ENDS = rf"(?U)\A{_SPACE}++|(?<!{_SPACE}){_SPACE}++\z"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c: Column | str) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(as_column(c), _RUN, " ")


def strip(c: Column | str) -> Column:
    """White space removed at both ends. Most texts have none there, and two characters tell."""
    c = as_column(c)
    touched = is_blank(F.substring(c, 1, 1)) | is_blank(F.substring(c, -1, 1))
    return F.when(touched, F.regexp_replace(c, _ENDS, "")).otherwise(c)


def clean_text(c: Column | str) -> Column:
    """Null becomes blank; ends stripped, runs collapsed, lower case."""
    # After collapse() the blank is the only white space left, so the cheap trim is enough.
    return F.lower(F.trim(collapse(F.coalesce(as_column(c), F.lit("")))))


def normalize_text(c: Column | str) -> Column:
    """Null becomes blank; cast to string; ends stripped."""
    return strip(F.coalesce(as_column(c).cast("string"), F.lit("")))


def is_blank(c: Column | str) -> Column:
    """Null and white space only are the same. The search stops at the first visible character."""
    return ~F.coalesce(as_column(c).cast("string"), F.lit("")).rlike(_VISIBLE)


def tokens(c: Column | str) -> Column:
    """White-space separated tokens."""
    return F.array_remove(F.split(as_column(c), _RUN), "")


def token_count(c: Column | str) -> Column:
    """Number of white-space separated tokens; null stays null."""
    c = as_column(c)
    return F.when(c.isNotNull(), F.size(tokens(c)).cast("bigint"))


def join_tokens(c: Column | str) -> Column:
    return F.array_join(as_column(c), " ")


def any_nonzero(c: Column | str) -> Column:
    """1 if some tag is non-zero; 0 for an empty or missing list."""
    return F.coalesce(F.exists(as_column(c), lambda t: t != 0), F.lit(False)).cast("int")


def capitalize(c: Column | str) -> Column:
    """First letter upper case, the rest lower case."""
    c = as_column(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))


def cut(c: Column | str, n: int) -> Column:
    return F.substring(as_column(c), 1, n)


def label_name(c: Column | str) -> Column:
    """Class code -> name; any other code keeps its number as text."""
    c = as_column(c)
    named = F.when(c == 0, V.LABEL_NAMES[0]).when(c == 1, V.LABEL_NAMES[1])
    return named.otherwise(c.cast("string"))


def field(c: Column, name: str, default: str = "") -> Column:
    """A field of a struct or map, with a default for a missing or null one."""
    return F.coalesce(c.getItem(name), F.lit(default))


def parse_json(c: Column | str, schema) -> Column:
    return F.from_json(as_column(c), schema)


def emit_json(c: Column | str) -> Column:
    return F.to_json(as_column(c))
