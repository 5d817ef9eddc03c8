"""Shannon entropy as a native column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two or more equal characters. Possessive, so that a long run needs neither backtracking nor stack.
REPEATED_CHARACTER = r"(?s)(.)\1++"


def shannon_entropy(text: Column) -> Column:
    """Base-2 entropy of the characters of ``text``, as a double.

    Over the n characters this is ``log2(n) - sum(c * log2(c)) / n``, where c
    runs over the counts of the distinct characters. The characters are sorted,
    so that each distinct one becomes a run whose length is its count; the cost
    does not grow with the size of the alphabet, and characters that occur once
    add nothing to the sum. NULL gives NULL and the empty string gives 0.
    """
    n = F.length(text)
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.regexp_extract_all(ordered, F.lit(REPEATED_CHARACTER), F.lit(0))
    weighted = F.aggregate(runs, F.lit(0.0), lambda acc, run: acc + F.length(run) * F.log2(F.length(run)))
    # rounding can leave a tiny negative value for one-character alphabets
    return F.when(n == 0, F.lit(0.0)).when(n > 0, F.greatest(F.log2(n) - weighted / n, F.lit(0.0)))
