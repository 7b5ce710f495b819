"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of each sales channel, compared after lower + trim.
CHANNEL_SPELLINGS = {
    "Web": ["web", "website"],
    "Mobile App": ["mobile app", "mobile", "app"],
    "Partner Marketplace": ["partner marketplace", "partner", "marketplace"],
}


def blank_to_null(c: Column) -> Column:
    """Strip spaces (only U+0020, not tabs or newlines); an empty result is NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def _capitalise(c: Column, word: str) -> Column:
    # Spark's initcap breaks words at spaces only, so split into words and separators first.
    # Plain ASCII words and spaces, the common case, need no splitting.
    pieces = F.regexp_extract_all(c, F.lit(f"([{word}]+|[^{word}]+)"), F.lit(1))
    by_piece = F.concat_ws("", F.transform(pieces, lambda piece: F.initcap(piece)))
    return F.when(c.rlike(r"^[A-Za-z ]*\z"), F.initcap(c)).when(c.isNotNull(), by_piece)


def initcap_words(c: Column) -> Column:
    """Title case where every non-alphanumeric character starts a new word (``home-garden`` → ``Home-Garden``)."""
    return _capitalise(c, r"\p{L}\p{N}")


def title_letters(c: Column) -> Column:
    """Title case where every non-letter starts a new word, digits included (``3rd`` → ``3Rd``)."""
    return _capitalise(c, r"\p{Lu}\p{Ll}\p{Lt}")


def strip_whitespace(c: Column) -> Column:
    """Strip any Unicode whitespace, not only spaces."""
    space = r"[\s\x1c-\x1f]"
    return F.regexp_replace(c, rf"(?U)\A{space}+|{space}+\z", "")


def title_clean(c: Column) -> Column:
    """Trim spaces, title-case every word, blank to NULL."""
    return F.nullif(initcap_words(F.trim(c)), F.lit(""))


def profile_category(c: Column) -> Column:
    """Category label as profiled by the generator: strip whitespace, title case, blank to NULL."""
    return F.nullif(title_letters(strip_whitespace(c)), F.lit(""))


def normalize_channel(c: Column) -> Column:
    """Map known spellings to a canonical channel; keep unknown labels in title case."""
    key = F.lower(F.trim(c))
    known = [F.when(key.isin(spellings), F.lit(name)) for name, spellings in CHANNEL_SPELLINGS.items()]
    return F.coalesce(*known, title_clean(c))


def normalize_status(c: Column) -> Column:
    return F.lower(blank_to_null(c))
