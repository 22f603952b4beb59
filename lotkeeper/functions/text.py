"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv

# Fixed value: the characters that count as white space when a string is stripped.
WHITESPACE = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
# A noncharacter never appears in text, so with a blank it can mark a word start for initcap.
_WORD_MARK = chr(0xFFFF) + " "
_WORD_START = "(?<=[^{0} ])(?=[{0}])"
_ANY_LETTER = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.trim(c, F.lit(WHITESPACE))


def is_ascii(c: Column) -> Column:
    """True for text of one byte per character, which needs no Unicode pattern."""
    return F.octet_length(c) == F.char_length(c)


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` alone starts words at blanks only, which leaves ``y15ZR`` as ``Y15zr``. A marker
    with a blank is put at each further word start and taken out again, so the whole expression
    stays inside generated code.
    """
    def mark(letters: str) -> Column:
        return F.regexp_replace(c, _WORD_START.format(letters), _WORD_MARK)

    marked = F.when(is_ascii(c), mark("a-zA-Z")).otherwise(mark(_ANY_LETTER))
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def clean_text(c: Column) -> Column:
    """Stripped title case; the text ``nan`` is a missing value."""
    return F.nullif(strip(title_case(c.cast("string"))), F.lit("Nan"))


def clean_subject(c: Column) -> Column:
    """Strip, drop pictographs, drop a trailing sales phrase, map nothing left to NULL.

    Each step reads the one before it once: a step named twice would be computed twice.
    """
    plain = F.when(is_ascii(c), c).otherwise(F.regexp_replace(c, fv.EMOJI_PATTERN, ""))
    text = strip(F.regexp_replace(strip(plain), fv.SUBJECT_NOISE_PATTERN, ""))
    return F.nullif(F.regexp_replace(text, "(?i)^nan$", ""), F.lit(""))


def fold(c: Column) -> Column:
    """Key form for curated mappings: lower case, stripped, NULL as the empty string."""
    return strip(F.lower(F.coalesce(c, F.lit(""))))


def match_key(c: Column) -> Column:
    """Model match key: lower-case letters a-z and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def make_slug(c: Column) -> Column:
    """Make match key before aliases: lower case with hyphens for blanks."""
    return F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit(" "), F.lit("-"))


def model_slug(c: Column) -> Column:
    """Vocabulary key of a model: runs of other characters become one hyphen."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-"),
                  F.lit("-"))


def clean_placeholder(c: Column) -> Column:
    """Strip; an empty cell or a lone hyphen is missing."""
    return F.nullif(F.nullif(strip(c), F.lit("")), F.lit("-"))


def remove_literal(text: Column, needle: Column) -> Column:
    """Remove every case-insensitive occurrence of a literal held in a column."""
    quoted = F.replace(F.coalesce(needle, F.lit("")), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.regexp_replace(text, F.concat(F.lit("(?iu)\\Q"), quoted, F.lit("\\E")), F.lit(""))


def variant_token(subject: Column, make: Column, model: Column) -> Column:
    """What is left of a subject once year, make, model, engine size and sales talk are gone."""
    text = F.regexp_replace(subject, fv.TOKEN_YEAR_PATTERN, "")
    text = remove_literal(remove_literal(text, make), model)
    for pattern in (fv.TOKEN_ENGINE_SIZE_PATTERN, fv.TOKEN_TRANSMISSION_PATTERN,
                    fv.TOKEN_CONDITION_PATTERN, fv.TOKEN_SEPARATOR_PATTERN,
                    fv.TOKEN_TRAILING_PATTERN):
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(F.regexp_replace(text, "[()]", " "), r"(?U)\s+", " ")
    return F.trim(text, F.lit(" -/|"))
