"""Display labels and ages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import SHORT_NAMES
from .places import mapped
from .text import grab

DAY_MS = 86400000.0


def grouped(c: Column) -> Column:
    """Number with thousands separators and at most three decimals."""
    return F.regexp_replace(F.format_number(F.round(c, 3), 3), r"\.?0+$", "")


def plain(c: Column) -> Column:
    """Number as text, without a trailing `.0`."""
    return F.regexp_replace(c.cast("decimal(30,6)").cast("string"), r"\.?0+$", "")


def euro(c: Column) -> Column:
    return F.concat(F.lit("€"), grouped(c))


def asking(price: Column) -> Column:
    """Price label of a priced listing; zero counts as unpriced."""
    return F.when(given(price), euro(price))


def given(c: Column) -> Column:
    """Shown at all: neither null nor zero."""
    return F.coalesce(c != 0, F.lit(False))


def price_label(price: Column, display: Column) -> Column:
    """Price or `Price on request`, with a mark on reserve prices."""
    reserve = F.when(F.contains(display, F.lit("reserve")), F.lit(" (reserve)")).otherwise(F.lit(""))
    return F.concat(F.coalesce(euro(price), F.lit("Price on request")), reserve)


def price_per_sqm(price: Column, plot: Column) -> Column:
    return F.when(given(price) & given(plot), price / plot)


def fixed_digits(c: Column, digits: int) -> Column:
    """Fixed decimals, exact ties up.

    ``format_number`` rounds the exact binary value with ties to even. A tie is
    exact only when the value is an odd multiple of 2^-(digits+1), so lift those.
    """
    scaled = c * float(2 ** (digits + 1))
    tie = (scaled == F.floor(scaled)) & (F.pmod(F.floor(scaled), F.lit(2)) == 1)
    return F.replace(F.format_number(F.when(tie, c + 10.0 ** -(digits + 2)).otherwise(c), digits), F.lit(","), F.lit(""))


def per_sqm_label(c: Column) -> Column:
    """`€1,250/m²`, `€9.9/m²`, `€0.03/m²`."""
    text = (
        F.when(c >= 10, F.format_number(F.floor(c + 0.5), 0)).when(c >= 1, fixed_digits(c, 1)).otherwise(fixed_digits(c, 2))
    )
    return F.concat(F.lit("€"), text, F.lit("/m²"))


def posted_rank(posted: Column) -> Column:
    """Age in days read from a relative posting text."""
    low = F.lower(posted)
    days = grab(low, r"(\d+)\s*day").try_cast("double")
    weeks = grab(low, r"(\d+)\s*week").try_cast("double")
    return (
        F.when(F.coalesce(low, F.lit("")) == "", F.lit(999.0))
        .when(F.contains(low, F.lit("hour")), F.lit(0.0))
        .when(low == "today", F.lit(0.5))
        .when(low == "yesterday", F.lit(1.0))
        .otherwise(F.coalesce(days, weeks * 7, F.lit(500.0)))
    )


def effective_age(posted_ts: Column, posted: Column, as_of_ms: int) -> Column:
    """Age in days at ``as_of_ms``: the exact time stamp, else the posting text."""
    return F.when(given(posted_ts), (F.lit(as_of_ms) - posted_ts) / DAY_MS).otherwise(posted_rank(posted))


def epoch_ms(text: Column) -> Column:
    """ISO date-time text to epoch milliseconds, null when it is not one."""
    return F.unix_millis(text.try_cast("timestamp"))


def posted_display(ms: Column) -> Column:
    """`9 Jul 2026`."""
    return F.date_format(F.timestamp_millis(ms), "d MMM yyyy")


def short_name(source: Column, kind: str) -> Column:
    return F.coalesce(mapped(source, SHORT_NAMES[kind]), F.split_part(source, F.lit(" "), F.lit(1)))
