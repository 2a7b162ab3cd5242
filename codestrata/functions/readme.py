"""README structure as a column expression."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from codestrata.functions.text import WORD, extract_all, pattern, strip

# Header form and header keywords.  An edge of a word is written as a look-around
# over the word class.
HEADER = r"^#{1,2}[<s>]+(.+)"
_EDGE_BEFORE = rf"(?<![{WORD}])"
_EDGE_AFTER = rf"(?![{WORD}])"
INSTALL_WORDS = _EDGE_BEFORE + r"install"
API_WORDS = _EDGE_BEFORE + r"(?:api|reference|docs?)" + _EDGE_AFTER
EXAMPLE_WORDS = _EDGE_BEFORE + r"(?:example|usage|getting[ -]started)" + _EDGE_AFTER


def headers(content: Column) -> Column:
    """Texts of first- and second-level headers."""
    return F.transform(extract_all(content, HEADER), strip)


def structure(content: Column, header_texts: Column) -> Column:
    joined = F.array_join(header_texts, " ")
    has = lambda words: F.rlike(joined, F.lit(pattern(words, "iu")))
    return F.struct(
        header_texts.alias("headers"),
        F.length(content).alias("length_chars"),
        has(INSTALL_WORDS).alias("has_installation"),
        has(API_WORDS).alias("has_api_docs"),
        has(EXAMPLE_WORDS).alias("has_examples"),
    )
