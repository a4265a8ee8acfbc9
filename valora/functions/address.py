"""Normalised addresses (D3, D4): accents, case, punctuation, abbreviations,
number suffixes and a postcode inside the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from valora.functions._col import as_col

ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
# Abbreviations of street types and names in French addresses.
ABBREVIATIONS = {
    "all": "allee", "av": "avenue", "ave": "avenue", "bd": "boulevard", "bld": "boulevard", "boul": "boulevard",
    "bvd": "boulevard", "ch": "chemin", "che": "chemin", "chem": "chemin", "crs": "cours", "dr": "docteur",
    "fbg": "faubourg", "fg": "faubourg", "gal": "general", "imp": "impasse", "mal": "marechal", "pass": "passage",
    "pl": "place", "pt": "petit", "qu": "quai", "r": "rue", "res": "residence", "rte": "route", "sq": "square",
    "st": "saint", "ste": "sainte",
}
# How a number's suffix is written.
SUFFIXES = {"b": "bis", "t": "ter", "q": "quater"}
# Words that say nothing about which street it is.
COMMON_WORDS = ["allee", "avenue", "boulevard", "chemin", "cours", "d", "de", "des", "du", "impasse", "l", "la", "le",
                "les", "passage", "place", "quai", "route", "rue", "square"]
_NUMBERED = r"^(\d+) ?(bis|ter|quater|[abct](?= ))? ?(.*?)( \d{5}( .*)?)?$"


def plain_words(c) -> Column:
    """Lower-case words of letters and digits, without accents, one space apart."""
    flat = F.translate(F.lower(as_col(c)), ACCENTED, PLAIN)
    flat = F.replace(F.replace(flat, F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae"))
    return F.btrim(F.regexp_replace(flat, "[^a-z0-9]+", " "))


def _named(words: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in words.items() for x in pair])


def street_key(c) -> Column:
    """A street's normalised name, abbreviations written out; '' becomes NULL."""
    words = F.transform(F.split(plain_words(c), " "), lambda w: F.coalesce(F.try_element_at(_named(ABBREVIATIONS), w), w))
    return F.nullif(F.array_join(words, " "), F.lit(""))


def suffix_key(c) -> Column:
    """A number's suffix: bis, ter, ...; '' where there is none."""
    s = F.coalesce(plain_words(c), F.lit(""))
    return F.coalesce(F.try_element_at(_named(SUFFIXES), s), s)


def parse_address(c) -> Column:
    """struct(number, suffix, street) of an address as one text; a postcode and
    what follows it is left out.  Without a number the number is NULL."""
    flat = plain_words(c)
    part = lambda k: F.regexp_extract(flat, _NUMBERED, k)
    numbered = F.regexp_like(flat, F.lit(r"^\d"))
    bare = F.regexp_replace(flat, r" \d{5}( .*)?$", "")
    return F.struct(F.when(numbered, part(1).try_cast("bigint")).alias("number"),
                    F.when(numbered, suffix_key(part(2))).otherwise(F.lit("")).alias("suffix"),
                    street_key(F.when(numbered, part(3)).otherwise(bare)).alias("street"))


def street_words(street: Column) -> Column:
    """The words of a normalised street that tell it apart."""
    return F.array_distinct(F.filter(F.split(street, " "), lambda w: (w != "") & ~w.isin(COMMON_WORDS)))
