"""Columns derived from file names and URIs.

File names follow ``variable_frequency_model_experiment_member_grid_year``
with an optional ``_v1.2`` and an optional ``_yearmean`` before ``.nc``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the file-name convention.
YEAR_PATTERN = r"_([0-9]{4})_"
VERSION_TAG = "_v1.2"
YEARMEAN_TAG = "_yearmean"

TOKENS = {"variable": 0, "frequency": 1, "model": 2, "experiment": 3, "member": 4, "grid": 5}


def strip_whitespace(c: Column) -> Column:
    """Remove any leading and trailing white space (``trim`` drops blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def uri_file_name(uri: Column) -> Column:
    """Last segment of the path of a URI; empty when there is none.

    The path is cut out by the generic syntax, so a URI with a brace or a blank
    has a name, too, which a strict parser refuses.
    """
    path = F.regexp_extract(uri, r"(?s)^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    return base_name(path)


def climate_file(path: Column) -> Column:
    """The ``.nc`` segment of a path: a decoded file, or the folder that holds its parts; else the base name."""
    found = F.regexp_extract(path, r"([^/]*[.]nc)(?:[.]parquet|/[^/]*)?$", 1)
    return F.coalesce(F.nullif(found, F.lit("")), base_name(path))


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def year_of_name(name: Column, strict: bool = False) -> Column:
    """First ``_YYYY_`` of the base name; NULL, or an error in strict mode.

    No match gives an empty string.  It becomes NULL before the cast: a failing
    ``try_cast`` raises and catches an error per row, ten times the cost of the
    whole parse.
    """
    digits = F.regexp_extract(base_name(name), YEAR_PATTERN, 1)
    year = F.nullif(digits, F.lit("")).cast("int")
    if not strict:
        return year
    message = F.concat(F.lit("no year in file name: "), name)
    return F.when(name.isNull() | year.isNotNull(), year).otherwise(
        F.raise_error(message).cast("int")
    )


def name_token(name: Column, token: str) -> Column:
    """One token of the naming convention, NULL when the name is too short."""
    return F.get(F.split(name, "_"), F.lit(TOKENS[token]))


def version_base(name: Column) -> Column:
    """Name up to the last ``_v1.2``, or without ``.nc`` when there is none.

    The tag of a reduced file is no part of the base, with a version or without.
    """
    tagged = F.regexp_extract(name, r"^(.*)_v1[.]2", 1)
    return F.when(F.contains(name, F.lit(VERSION_TAG)), tagged).otherwise(
        F.regexp_replace(name, r"(?:_yearmean)?[.]nc$", "")
    )


def stem(name: Column) -> Column:
    """What a raw file, its re-issued version and its yearly mean have in common."""
    return F.regexp_replace(name, r"_v1[.]2|_yearmean|[.]nc", "")


def version_of(name: Column) -> Column:
    """``v1.2`` for a re-issued file, else NULL."""
    return F.when(F.contains(name, F.lit(VERSION_TAG)), F.lit("v1.2"))


def version_name(name: Column) -> Column:
    return F.concat(version_base(name), F.lit(VERSION_TAG + ".nc"))


def yearmean_name(name: Column) -> Column:
    return F.replace(name, F.lit(".nc"), F.lit(YEARMEAN_TAG + ".nc"))


def is_yearmean(name: Column) -> Column:
    return F.contains(name, F.lit(YEARMEAN_TAG))


def contains_any(c: Column, needles: Sequence[str]) -> Column:
    """True when ``c`` contains one of ``needles`` as a substring.

    Apply it to a stored column: a filter is pushed below its projection and
    would repeat a computed one for every needle.
    """
    return reduce(or_, [c.contains(n) for n in needles])


def wanted_variable(name: Column) -> Column:
    """Mean temperature (but not its daily extremes) or precipitation.

    One pattern, so that a computed name is evaluated once.
    """
    return name.rlike("(?s)^(?:.*pr|(?!.*tasm(?:in|ax)).*tas)")


def series_label(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)
