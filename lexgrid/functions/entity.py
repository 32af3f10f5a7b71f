"""Source-trust tier and name normalisation.

Tier rule, highest trust first: a row flagged as coming from source 1; an id
with the 9999 prefix; an id with the 99998888 prefix; anything else last. Every
99998888 id also starts with 9999, so the longer prefix is tested first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the trust rule.
SOURCE1_TIER = 1
PREFIX_9999_TIER = 2
PREFIX_99998888_TIER = 3
OTHER_TIER = 4
PREFIX_9999 = "9999"
PREFIX_99998888 = "99998888"

# Width folding: full-width ASCII variants U+FF01..U+FF5E map to U+0021..U+007E,
# and the ideographic space U+3000 to a plain space. Built from the rule.
FULLWIDTH_FROM = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
HALFWIDTH_TO = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "

# A trailing branch name in ASCII or full-width brackets, e.g. "Tea (North Gate)".
BRANCH_SUFFIX = "[（(][^）)]*[)）][ \\t\\n\\r\\f\\x0B]*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Words that flag a listing as coming from source 1, in any case.
YES_VALUES = ("yes", "y", "true", "1", "是")


def is_flagged(flag: Column | str, yes_values: Sequence[str] = YES_VALUES) -> Column:
    """Source-1 flag: one of ``yes_values``; any other value, blank or null is no flag."""
    return F.coalesce(F.lower(F.trim(_col(flag))).isin(*yes_values), F.lit(False))


def trust_tier(flag: Column | str, brand_id: Column | str, yes_values: Sequence[str] = YES_VALUES) -> Column:
    """B1: 1 source-1, 2 prefix 9999, 3 prefix 99998888, 4 other. Ids are strings."""
    bid = F.coalesce(F.trim(_col(brand_id)), F.lit(""))
    return (F.when(is_flagged(flag, yes_values), F.lit(SOURCE1_TIER))
            .when(bid.startswith(PREFIX_99998888), F.lit(PREFIX_99998888_TIER))
            .when(bid.startswith(PREFIX_9999), F.lit(PREFIX_9999_TIER))
            .otherwise(F.lit(OTHER_TIER)))


def fold_width(name: Column | str) -> Column:
    return F.translate(_col(name), FULLWIDTH_FROM, HALFWIDTH_TO)


def normalise_name(name: Column | str) -> Column:
    """B2: drop a trailing bracketed branch name, fold width, lower-case, trim."""
    c = F.regexp_replace(_col(name), BRANCH_SUFFIX, "")
    c = F.lower(fold_width(c))
    return F.trim(F.regexp_replace(c, "[ \\t\\n\\r\\f\\x0B]+", " "))
