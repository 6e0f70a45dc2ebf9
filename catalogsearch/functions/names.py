"""Display names as safe identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogsearch.functions.binding import bind

# The characters not allowed first, in between and last.
FORBIDDEN_FIRST = "-&%=+'\"<>#|!()*,/;[\\]^{}~0123456789\x00."
FORBIDDEN_MIDDLE = "-&%=+'\"<>#|!()/?[\\]^`{}~.*@$"
FORBIDDEN_LAST = "-&%=+:'\"<>#|!(),./@[\\]^{}~"

DIGITS = "0123456789"


def _underscored(text: Column, forbidden: str) -> Column:
    return F.translate(text, forbidden, "_" * len(forbidden))


def _cleaned(name: Column) -> Column:
    size = F.length(name)
    first = F.substring(name, 1, 1)
    middle = name.substr(F.lit(2), F.greatest(size - 2, F.lit(0)))
    last = F.substring(name, -1, 1)
    symbols = "".join(c for c in FORBIDDEN_FIRST if c not in DIGITS)
    head = F.when(first.rlike("^[0-9]"), F.concat(F.lit("_"), first)).otherwise(_underscored(first, symbols))
    single = _underscored(_underscored(name, FORBIDDEN_FIRST), FORBIDDEN_LAST)
    joined = F.concat(head, _underscored(middle, FORBIDDEN_MIDDLE), _underscored(last, FORBIDDEN_LAST))
    return F.regexp_replace(F.when(size == 1, single).when(size > 1, joined).otherwise(name), "_+", "_")


def clean_display_name(name: Column) -> Column:
    """Replace forbidden characters by position and collapse runs of underscores.

    A leading digit is kept behind an underscore; a name that is a single forbidden
    character or digit becomes one underscore.
    """
    return bind(name, lambda n: F.when(n.isNotNull(), _cleaned(n)))
