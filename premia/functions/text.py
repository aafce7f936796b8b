"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

# The spellings that count as the United States. "u.s.a" is not one of them.
USA_SPELLINGS = ("usa", "u.s.", "u.s", "united states", "united states of america", "us")

# Cell texts that mean "no value" in a delimited file.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(c: Column) -> Column:
    """Remove leading and trailing white space of any kind; SQL ``trim`` removes blanks only."""
    # Looking up characters in the list is slow, and most cells begin and end with printable ASCII.
    last = F.substring(c.cast("binary"), -1, 1)  # of bytes, as those of text are counted from the first
    printable = (c >= "!") & (c < "\x7f") & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))
    return F.when(printable, c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def squeeze_space(c: Column) -> Column:
    """Turn each run of white space into one blank and strip both ends."""
    return F.trim(F.regexp_replace(c, f"[{WHITE_SPACE}]+", " "))


def blank_to_null(c: Column, texts: Iterable[str] = MISSING_TEXTS) -> Column:
    return F.when(~c.isin(*texts), c)


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters (``o'brien`` to ``O'Brien``)."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.concat(F.upper(F.substr(run, F.lit(1), F.lit(1))), F.substr(run, F.lit(2)))), "")


def id_text(c: Column) -> Column:
    """Ids are trimmed text; a missing id is the empty text."""
    return strip_space(F.coalesce(c.cast("string"), F.lit("")))


def postal_text(c: Column) -> Column:
    """Postal codes are text; drop the ``.0`` left by a numeric reader."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\.0$", "")


def country_name(c: Column, spellings: Sequence[str] = USA_SPELLINGS, name: str = "USA") -> Column:
    return F.when(F.lower(strip_space(c)).isin(*spellings), F.lit(name)).otherwise(c)


def canonical_value(c: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    """Replace known spellings, given in lower case per canonical value; keep all other values."""
    # One lookup: a chain of conditions would clean the text once per spelling.
    canonical = {v: name for name, variants in spellings.items() for v in variants}
    if not canonical:
        return c
    known = F.create_map(*[F.lit(x) for pair in canonical.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(strip_space(c))), c)
