"""Words of a text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a word.  (?U) keeps the boundary Unicode-aware on
# every JDK, so a run of letters touching a digit or an underscore is no word.
WORD_PATTERN = r"(?U)\b[a-zA-Z\u00c0-\uFFFF]+\b"


def words(text: Column) -> Column:
    """Array of all words of ``text``, in order and in their original case."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
