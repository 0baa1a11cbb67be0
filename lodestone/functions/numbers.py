"""Number parsing. A text that does not parse is null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import grab, grab_all, has, nth, swap


def number(c: Column) -> Column:
    """Plain number, null when the text is not one."""
    return c.try_cast("double")


def present(c: Column) -> Column:
    """Zero means absent."""
    return F.nullif(c, F.lit(0.0))


def half_up(c: Column) -> Column:
    return F.floor(c + F.lit(0.5)).cast("double")


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


def keep_only(c: Column, allowed: str) -> Column:
    return swap(c, f"[^{allowed}]", "")


def drop_chars(c: Column, chars: str) -> Column:
    return swap(c, f"[{chars}]", "")


# --- prices ---------------------------------------------------------------


def price_commas(text: Column) -> Column:
    """`€250,000`: symbol and commas removed; zero is absent."""
    return present(number(drop_chars(text, r"€,\s")))


def price_dots(text: Column) -> Column:
    """`150.000`: dots are separators; a decimal comma makes it unreadable."""
    return number(drop_chars(text, r"€\.\s"))


def price_both(text: Column) -> Column:
    """Both separators removed."""
    return number(drop_chars(text, ".,"))


def price_decimal(text: Column) -> Column:
    """Digits and dot kept; zero is absent."""
    return present(number(keep_only(text, r"\d.")))


def price_digits(text: Column) -> Column:
    """Digits kept; zero is absent."""
    return present(number(keep_only(text, r"\d")))


def price_or_millions(text: Column) -> Column:
    """`€647,000`, else `€1,09M`."""
    full = number(drop_chars(grab(text, r"€\s?([\d,]{4,})(?![\d,]*M)"), ","))
    whole, part = (grab(text, r"€\s?(\d+)(?:[.,](\d+))?M", g) for g in (1, 2))
    return F.coalesce(full, half_up(number(F.concat(whole, F.lit("."), F.coalesce(part, F.lit("0")))) * 1000000))


def price_bracketed(text: Column) -> Column:
    """The euro amount in brackets wins over any other euro amount."""
    return number(drop_chars(F.coalesce(grab(text, r"\[€([\d,]+)\]"), grab(text, r"€([\d,]+)")), ","))


def price_either_side(text: Column) -> Column:
    """Symbol before or after at least four digits or separators."""
    return price_both(F.coalesce(grab(text, r"€\s?(\d[\d.,]{3,})"), grab(text, r"(\d[\d.,]{3,})\s?€")))


def price_euro_commas(text: Column) -> Column:
    """`€` directly followed by digits and commas; zero stays zero."""
    return number(drop_chars(grab(text, r"€([\d,]+)"), ","))


# --- areas, counts, years --------------------------------------------------


def to_int(c: Column) -> Column:
    """Digits and dot kept, rounded, positive or null."""
    return positive_rounded(number(keep_only(c, r"\d.")))


def positive_rounded(c: Column) -> Column:
    return F.when(c > 0, half_up(c))


def rounded_number(c: Column) -> Column:
    """Digits and dot kept, rounded; zero is absent."""
    return present(half_up(number(keep_only(c, r"\d."))))


def grab_number(text: Column, pattern: str, separators: str = ",") -> Column:
    """Positive number behind a pattern."""
    return positive(number(drop_chars(grab(text, pattern), separators)))


def int_of(c: Column) -> Column:
    """Whole number; null beyond the range of an int."""
    return number(c).try_cast("int")


def year_between(c: Column) -> Column:
    return F.when((c > 1800) & (c < 2100), c)


def area_any_unit(text: Column) -> Column:
    """`93 m²`, `272sqm`, `272 m2`; separators removed, rounded."""
    return half_up(price_both(grab(text, r"(?i)([\d.,]+)\s*(?:m²|m2|sqm)")))


def areas(text: Column, n: int) -> Column:
    """The n-th `N m²` of a text; zero is absent."""
    return present(number(nth(grab_all(text, r"(\d+)\s*m²"), n)))


def strong_attr(html: Column, label: str) -> Column:
    """`<strong>N</strong> label` in any case, both separators removed."""
    return strong_in(F.lower(html), label)


def strong_in(low: Column, label: str) -> Column:
    """The same in lower-case markup: a plain word is searched in jumps, one of any case letter by letter."""
    return price_both(grab(low, rf"<strong>\s*([\d,.]+)\s*</strong>\s*{label.lower()}"))


def icon_attr(html: Column, icon: str) -> Column:
    """Number behind an icon element."""
    return icon_in(F.lower(html), icon)


def icon_in(low: Column, icon: str) -> Column:
    """The same in lower-case markup."""
    return price_both(grab(low, rf"fa-{icon}[^>]*></i>\s*([\d,.]+)"))


def notice_area(token: Column) -> Column:
    """Area token of a notice: European decimals; null when it is not a plain number."""
    plain = F.replace(F.replace(token, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(has(plain, r"^\d{1,7}(?:\.\d+)?$"), half_up(number(plain)))


def share_is_valid(token: Column) -> Column:
    """`n/d` with 0 < n <= d."""
    top, bottom = (F.substring_index(token, "/", at).try_cast("int") for at in (1, -1))
    return has(token, r"^\d{1,4}/\d{1,5}$") & F.coalesce((top > 0) & (top <= bottom), F.lit(False))
