"""Word and character functions over string columns, all JVM-side."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.split() takes as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set for Java. Unicode-aware \s lacks only the four information separators; a class
# that lists the ranges is three times slower, as Java tests them one by one per character.
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def words(text: Column) -> Column:
    """Words between runs of Unicode whitespace; no empty ones."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def strip(text: Column) -> Column:
    """Text without Unicode whitespace at either end."""
    return F.btrim(text, F.lit(WHITESPACE))


def overlapping_windows(word_array: Column, size: int, overlap: int) -> Column:
    """One space-joined string per window of ``size`` words, each sharing ``overlap``
    words with the one before. A window starts every ``size - overlap`` words for as
    long as a word is left there. NULL when there are no words.
    """
    stride = size - overlap
    starts = F.sequence(F.lit(0), F.size(word_array) - 1, F.lit(stride))
    joined = F.transform(starts, lambda s: F.array_join(F.slice(word_array, s + 1, F.lit(size)), " "))
    return F.when(F.size(word_array) > 0, joined)


def cut(text: Column, limit: int) -> Column:
    """The first ``limit`` characters (code points)."""
    return F.substring(text, 1, limit)
