"""District resolution. Each resolver is one CASE chain built from a fixed table."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import DISTRICT_CANON, DISTRICT_TRANSLITERATED, DISTRICTS
from .text import blank_to_null, has, last, trim


def literal_map(pairs: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def mapped(c: Column, pairs: Mapping[str, str]) -> Column:
    return F.try_element_at(literal_map(pairs), c)


def canonical(district: Column) -> Column:
    """Final spelling of a district; an unknown one stays."""
    return F.coalesce(mapped(district, DISTRICT_CANON), district)


def _first(tests: Iterable[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(test, F.lit(value)) for test, value in tests])


def _holds(text: Column, word: str, pattern: str) -> Column:
    """Pattern test behind a literal test: most texts do not hold the word at all."""
    return F.contains(F.lower(text), F.lit(word.lower())) & has(text, pattern)


def _words(text: Column, names: Mapping[str, str]) -> Column:
    return _first((_holds(text, name, rf"(?i)\b{name}\b"), value) for name, value in names.items())


_SELF = {d: d for d in DISTRICTS}


def by_substring(text: Column) -> Column:
    """District named anywhere in the text, else `Other`."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(_first((F.contains(low, F.lit(d.lower())), d) for d in DISTRICTS), F.lit("Other"))


def by_alias(text: Column, aliases: Mapping[str, str]) -> Column:
    """District, else first alias contained in the text; case matters."""
    return _first((F.contains(text, F.lit(name)), value) for name, value in {**_SELF, **aliases}.items())


def by_first_segment(text: Column, areas: Mapping[str, str], transliterate: bool = True) -> Column:
    """District word, transliterated word, known prefix of the first segment, or that segment."""
    text = F.coalesce(text, F.lit(""))
    first = trim(F.split_part(text, F.lit(","), F.lit(1)))
    picks = [_words(text, _SELF)]
    if transliterate:
        picks.append(_words(text, DISTRICT_TRANSLITERATED))
    picks.append(_first((F.contains(text, F.lit(a)) & has(text, rf"^\s*{a}"), d) for a, d in areas.items()))
    return F.coalesce(*picks, blank_to_null(first))


def by_last_segment(text: Column, areas: Mapping[str, str]) -> Column:
    """District word, word that starts with a known area, or the last segment."""
    text = F.coalesce(text, F.lit(""))
    return F.coalesce(
        _words(text, _SELF),
        _first((_holds(text, a, rf"(?i)\b{a}"), d) for a, d in areas.items()),
        blank_to_null(trim(last(F.split(text, ",")))),
    )


def by_word(text: Column) -> Column:
    """District word or null."""
    return _words(F.coalesce(text, F.lit("")), _SELF)


def by_code(word: Column, codes: Mapping[str, str], otherwise: Column) -> Column:
    """Exact table entry, a fallback for other words, `Other` without a word."""
    return F.when(word.isNull(), F.lit("Other")).otherwise(F.coalesce(mapped(word, codes), otherwise))


def comma_parts(text: Column) -> Column:
    return F.transform(F.split(text, ","), trim)
