"""Text helpers with the exact white-space and digit classes of the exchanged records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped.
BLANKS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Drop white space at both ends; ``trim`` would only drop blanks."""
    return F.regexp_replace(col(c), rf"^{BLANKS}+|{BLANKS}+\z", "")


def or_default(c: Column | str, default: Column | str) -> Column:
    """The text, or the default where it is null or empty."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(col(c), F.lit("")), fallback)


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text of a timestamp in UTC; the fraction is left out when it is zero."""
    whole = F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.pmod(F.unix_micros(col(ts)), F.lit(1_000_000))
    return F.concat(
        whole,
        F.when(fraction == 0, "").otherwise(F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))),
        F.lit("+00:00"),
    )


def json_of_map(m: Column | str) -> Column:
    """JSON text of a map with its entries in key order, so equal maps give equal text."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col(m)))))


def map_of(pairs: dict[str, Column]) -> Column:
    """Map literal with string values; null values are left out."""
    flat = []
    for key, value in pairs.items():
        flat += [F.lit(key), value.cast("string")]
    return F.map_filter(F.create_map(*flat), lambda _, v: v.isNotNull())
