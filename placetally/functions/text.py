"""Tokenizer expressions: plain column functions, no Python workers involved."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the word rules, as regular expressions and trim sets.
REMOVED = r'[#.!?,"(){}\[\]|]|&amp;'
LEADING_TRIM = "@\\/~"
TRAILING_TRIM = "\\/:~"
URL_PREFIX = "http"

_SPACE = r" \t\n\r\x0B\f"
_URL = rf"(?<![^{_SPACE}]){URL_PREFIX}[^{_SPACE}]*"


def ascii_fold(text: Column) -> Column:
    """Lower-case, then drop every non-ASCII character.

    A no-break space vanishes too, so the words on both sides of it join up.
    """
    lowered = F.lower(text)
    is_ascii = F.octet_length(text) == F.length(text)
    return F.when(is_ascii, lowered).otherwise(F.regexp_replace(lowered, r"[^\x00-\x7F]+", ""))


def drop_urls(folded: Column) -> Column:
    """Blank out whitespace-separated tokens that start with ``http``.

    Runs before punctuation is removed, so ``(http://...`` is kept as a word.
    """
    return F.when(
        F.contains(folded, F.lit(URL_PREFIX)), F.regexp_replace(folded, _URL, "")
    ).otherwise(folded)


def remove_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, REMOVED, "")


def trim_ends(text: Column) -> Column:
    return F.rtrim(F.ltrim(text, F.lit(LEADING_TRIM)), F.lit(TRAILING_TRIM))


def clean_token(token: Column) -> Column:
    """Remove punctuation anywhere in the token, then trim its two ends."""
    return trim_ends(remove_punctuation(token))


def tokens(folded: Column) -> Column:
    """Array of the tokens of a folded text, without punctuation but with untrimmed ends.

    Removed characters are never whitespace, so removing them from the text once
    before the split gives the same tokens as cleaning each of them after it.
    """
    return F.split(remove_punctuation(drop_urls(folded)), f"[{_SPACE}]+")
