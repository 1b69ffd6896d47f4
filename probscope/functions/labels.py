"""Label, taxonomy and text expressions (all JVM built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Match levels by trailing zero digits of a 4-digit class id.
LEVELS = ["exact", "category", "general", "broad"]
LEVEL_DIVISOR = {"exact": 1, "category": 10, "general": 100, "broad": 1000}


def match_level(class_id, matchable=None) -> Column:
    """n000 broad, nn00 general, nnn0 category, nnnn exact; fewer than 4 digits
    (and anything flagged not matchable) is 'none'."""
    c = _c(class_id)
    lvl = (F.when(c < 1000, F.lit("none"))
           .when(c % 1000 == 0, F.lit("broad"))
           .when(c % 100 == 0, F.lit("general"))
           .when(c % 10 == 0, F.lit("category"))
           .otherwise(F.lit("exact")))
    if matchable is not None:
        lvl = F.when(F.coalesce(_c(matchable), F.lit(True)), lvl).otherwise(F.lit("none"))
    return lvl


def truncate_to_level(class_id, level: str) -> Column:
    """Class id with its last digits zeroed to compare at a coarser level."""
    d = LEVEL_DIVISOR[level]
    return (F.floor(_c(class_id) / d) * d).cast("int")


def taxonomy_sort_key(class_id, maxdigits) -> Column:
    """Right-pad the id with zeros to ``maxdigits`` so subclasses sort after their class."""
    md = maxdigits if isinstance(maxdigits, Column) else F.lit(maxdigits)
    return F.rpad(_c(class_id).cast("string"), md, "0").cast("long")


def py_str(x) -> Column:
    """Text of a value as Python would print it inside an f-string (NULL -> 'None')."""
    return F.coalesce(_c(x).cast("string"), F.lit("None"))


def classifier_title(*cols) -> Column:
    """'broker version name [params]' joined by spaces, NULL printed as None."""
    return F.concat_ws(" ", *[py_str(c) for c in cols])


def count_text(n) -> Column:
    """``str(n)`` below one million, else ``f'{n:.3g}'`` (Java pads zeros; strip them)."""
    n = _c(n)
    sci = F.regexp_replace(F.format_string("%.3g", n.cast("double")), r"\.?0+e", "e")
    return F.when(n < 1_000_000, n.cast("long").cast("string")).otherwise(sci)


def cell_annotation(n, fraction) -> Column:
    """'<round-half-even(100 f)>%\\n<count>' as printed by a NumPy float."""
    pct = F.rint(_c(fraction) * 100.0).cast("string")
    return F.concat(pct, F.lit("%\n"), count_text(n))


def pad_right(x, width: int) -> Column:
    """Left-aligned text padded with spaces to at least ``width`` (never truncated,
    unlike ``rpad``), as Python's ``f'{x:{width}s}'`` does."""
    t = py_str(x)
    return F.concat(t, F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(width) - F.length(t))))


# Column widths of the printed classifier listing (broker, classifier, version, params).
LISTING_WIDTHS = (20, 32, 16, 12)


def classifier_listing_key(broker, classifier, version, params) -> Column:
    """The printed listing line 'broker  classifier  version  params' in fixed-width
    columns; sorting by it gives the listing order."""
    w = LISTING_WIDTHS
    return F.concat_ws("  ", pad_right(broker, w[0]), pad_right(classifier, w[1]), pad_right(version, w[2]),
                       pad_right(params, w[3]))
