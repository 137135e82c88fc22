"""Column expressions for cleaning text fields.

Each one yields NULL for text it cannot read, with ANSI mode on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.layers import DATE_PATTERN


def landing_date(text: Column) -> Column:
    """M/D/YYYY to a date. The text is not trimmed: a padded date is NULL."""
    return F.try_to_date(text, DATE_PATTERN)


def whole_number(text: Column) -> Column:
    return text.try_cast("int")


def name_part(full_name: Column, position: int) -> Column:
    """Part 0 ends at the first space, part 1 is all that follows it."""
    return F.get(F.split(F.trim(full_name), " ", 2), F.lit(position))


def form_decoded(text: Column) -> Column:
    """Undo form-style URL encoding; a percent sign that starts no escape stays as it is."""
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))
