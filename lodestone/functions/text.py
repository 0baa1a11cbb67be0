"""Text functions over columns."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the capture pages use it: Java's \s plus the Unicode blanks. The range before them
# turns an ASCII character away at once; without it each one is held against every single blank.
BLANK = r"\s[\u00A0-\uFEFF&&[\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]]"
BLANKS = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
_BOUNDARY = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"


def rx(pattern: str) -> str:
    """Java form of a pattern: wide ``\\s``, ASCII ``\\b``, ``$`` only at the very end."""
    out, i, in_class = [], 0, False
    pattern = pattern.replace(r"[\s\S]", "(?s:.)")
    while i < len(pattern):
        pair = pattern[i : i + 2]
        if pair == r"\s":
            out.append(BLANK if in_class else f"[{BLANK}]")
        elif pair == r"\b" and not in_class:
            out.append(_BOUNDARY)
        elif pair[0] == "\\":
            out.append(pair)
        elif pair[0] == "$" and not in_class:
            out.append(r"\z")
        else:
            in_class = {"[": True, "]": False}.get(pair[0], in_class)
            out.append(pair[0])
            i += 1
            continue
        i += 1 if pair[0] == "$" else 2
    return "".join(out)


def grab(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, or null.

    Taken through an array, the match is searched once: `nullif` searches twice where it is one of several choices.
    And a projection with many patterns compiles to many short methods, where whole-stage code made one that the
    JVM holds too long to compile.
    """
    found = F.array(F.regexp_extract(c, rx(pattern), group))
    return F.try_element_at(F.filter(found, lambda x: x != ""), F.lit(1))


def grab_all(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(rx(pattern)), F.lit(group))


def has(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(rx(pattern)), F.lit(False))


def swap(c: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(c, rx(pattern), replacement)


def clean(c: Column) -> Column:
    """Collapse white space and trim."""
    # A single plain blank is what it should be already, so it is no match.
    return F.trim(F.regexp_replace(c, f"(?: [{BLANK}]+|[{BLANK}&&[^ ]][{BLANK}]*)", " "))


def trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def strip_tags(c: Column) -> Column:
    return clean(swap(c, r"<[^>]+>", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def replace_all(c: Column, pairs: dict[str, str]) -> Column:
    """Literal replacements, in order."""
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), pairs.items(), c)


def lines(c: Column) -> Column:
    """Trimmed, non-empty lines of a card text."""
    return F.filter(F.transform(F.split(c, "\n"), trim), lambda x: x != "")


def first_where(array: Column, test) -> Column:
    return F.try_element_at(F.filter(array, test), F.lit(1))


def nth(array: Column, n: int) -> Column:
    return F.try_element_at(array, F.lit(n))


def last(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def labelled(c: Column, before: str, label: str, after: str, value: str) -> Column:
    """Value that follows a label in markup."""
    return grab(c, f"{before}{label}{after}({value})")


def title_case(c: Column) -> Column:
    """Upper-case each ASCII letter that starts a word; collapse white space.

    The word boundary is the ASCII one, so a Greek word start stays as it is.
    """
    pieces = F.split(F.lower(c), r"(?<![A-Za-z0-9_])(?=[a-z])")
    return clean(F.array_join(F.transform(pieces, _capital), ""))


def _capital(piece: Column) -> Column:
    return F.when(piece.rlike("^[a-z]"), F.concat(F.upper(F.left(piece, F.lit(1))), F.substr(piece, F.lit(2)))).otherwise(
        piece
    )


def slug_title(link: Column) -> Column:
    """Title from the readable part of a detail link."""
    words = F.replace(grab(link, r"(?i)/([a-z0-9-]+?)-\d+/?$"), F.lit("-"), F.lit(" "))
    pieces = F.split(words, r"(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substr(p, F.lit(2)))), ""
    )


def absolute(link: Column, site: str) -> Column:
    return F.when(F.startswith(link, F.lit("http")), link).otherwise(F.concat(F.lit(site), link))


def without_query(link: Column) -> Column:
    return F.split_part(link, F.lit("?"), F.lit(1))


def link_key(link: Column) -> Column:
    """Identity of a link: lower case, no trailing slashes, empty means none."""
    return F.nullif(F.rtrim(F.lower(link), F.lit("/")), F.lit(""))


def contains_text(c: Column, needle: str) -> Column:
    """Case-insensitive literal containment; null counts as empty text."""
    return F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(needle.lower()))


def plot_type(title: Column, words, field_is_agricultural: bool) -> Column:
    """Plot type named in a title, first word of the list that occurs."""
    low = F.lower(F.coalesce(title, F.lit("")))
    picks = [F.when(F.contains(low, F.lit(w)), F.lit(w.capitalize())) for w in words]
    if field_is_agricultural:
        picks.append(F.when(has(low, r"\bfield\b"), F.lit("Agricultural")))
    return F.coalesce(*picks)


def planning_zone(c: Column) -> Column:
    """Zone code; dashes and blanks mean none."""
    return F.when(~has(c, r"^[-\s]*$"), c)
