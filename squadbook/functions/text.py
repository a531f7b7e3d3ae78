"""Text folding, splitting and whole-word containment as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word character is a letter, a number or the underscore.
WORD = r"\p{L}\p{N}_"


def strip(column: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(column, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def escape_regex(column: Column) -> Column:
    """Backslash every character a regular expression could take as an operator."""
    return F.regexp_replace(column, r"([^\p{L}\p{N}\s_])", r"\\$1")


def contains_phrase(text: Column, phrase: Column, boundary: str = "word") -> Column:
    """Whether ``phrase`` occurs in ``text`` between word boundaries, ignoring case.

    A boundary lies where a word character meets a non-word character or an end of
    the text, so a phrase ending in ``.`` needs a word character right after it. With
    ``boundary="loose"`` the phrase must not touch a word character on either side.
    """
    if boundary == "word":
        edge = f"(?<![{WORD}])(?=[{WORD}])|(?<=[{WORD}])(?![{WORD}])"
        left = right = f"(?:{edge})"
    elif boundary == "loose":
        left, right = f"(?<![{WORD}])", f"(?![{WORD}])"
    else:
        raise ValueError("boundary must be 'word' or 'loose'")
    pattern = F.concat(F.lit(left), escape_regex(F.lower(phrase)), F.lit(right))
    # Most texts lack the phrase altogether, which a plain search finds out faster.
    folded = F.lower(text)
    return F.contains(folded, F.lower(phrase)) & F.regexp_like(folded, pattern)


def segments(text: Column, single: bool = False) -> Column:
    """Cut a text at every word boundary: ``neymar jr.`` -> ``[neymar, ' ', jr, .]``.

    ``single`` also cuts non-word characters from each other.
    """
    other = f"[^{WORD}]" if single else f"[^{WORD}]++"
    return F.regexp_extract_all(text, F.lit(f"[{WORD}]++|{other}"), F.lit(0))
