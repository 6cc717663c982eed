"""Normalisation of names, addresses and countries as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions import rules
from linkloom.functions.fold import to_ascii

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BLANKS = r"[\t-\r \x1c-\x1f]+"


def clean(text: Column, other_scripts: bool = True) -> Column:
    """ASCII, lower case, punctuation and runs of white space as one space, trimmed; null is empty."""
    low = F.lower(to_ascii(F.coalesce(text, F.lit("")), other_scripts))
    return F.trim(F.regexp_replace(F.translate(low, PUNCTUATION, " " * len(PUNCTUATION)), BLANKS, " "))


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _by_country(country: Column, make: Callable[[rules.Locale], Column]) -> Column:
    case = None
    for code in rules.locales():
        case = (F if case is None else case).when(country == code, make(rules.rules_for(code)))
    other = make(rules.rules_for(""))
    return other if case is None else case.otherwise(other)


def _words(text: Column, table: dict[str, str]) -> Column:
    return F.transform(F.split(text, " "), lambda t: F.coalesce(F.try_element_at(_map(table), t), t))


def _phrases(text: Column, table: dict[str, str]) -> Column:
    """Phrases rewritten, longest first; with the spaces doubled, neighbours don't share one."""
    if not table:
        return text
    wide = F.concat(F.lit(" "), F.replace(text, F.lit(" "), F.lit("  ")), F.lit(" "))
    for old, new in sorted(table.items(), key=lambda p: -len(p[0].split())):
        wide = F.replace(wide, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(wide, " +", " "))


def suffixes(cleaned: Column, country: Column) -> Column:
    """Legal forms and other words of a cleaned name rewritten by the country's rules."""
    return _by_country(country, lambda r: _phrases(F.array_join(_words(cleaned, r.name), " "), r.phrases))


def normalize_name(name: Column, country: Column, other_scripts: bool = True) -> Column:
    return suffixes(clean(name, other_scripts), country)


def address_tokens(cleaned: Column, country: Column) -> Column:
    return F.filter(_by_country(country, lambda r: _words(cleaned, r.address)), lambda t: t != "")


def street_number(tokens: Column) -> Column:
    """The first token that is a number, with at most one letter after it; null if there is none."""
    return F.try_element_at(F.filter(tokens, lambda t: t.rlike("^[0-9]+[a-z]?$")), F.lit(1))


def number_first(tokens: Column, number: Column) -> Column:
    """The address with its street number, if any, moved to the front."""
    at = F.array_position(tokens, number)
    rest = F.concat(F.slice(tokens, F.lit(1), (at - 1).cast("int")), F.slice(tokens, (at + 1).cast("int"), F.size(tokens)))
    return F.when(number.isNull(), F.array_join(tokens, " ")).otherwise(F.trim(F.concat_ws(" ", number, F.array_join(rest, " "))))


def normalize_country(country: Column) -> Column:
    code = F.upper(F.trim(F.coalesce(country, F.lit(""))))
    return F.when(code == "", "UNKNOWN").otherwise(F.coalesce(F.try_element_at(_map(rules.COUNTRIES), code), code))


def numeric_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\b\d+\b"), F.lit(0))


def char_ngrams(text: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams of every word, padded with a space on both sides; a padded word shorter than n gives itself."""

    def of(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        return F.flatten(F.array(*[_grams(padded, n) for n in range(low, high + 1)]))

    return F.flatten(F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), of))


def _grams(padded: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n)))
