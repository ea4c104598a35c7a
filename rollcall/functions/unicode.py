"""NFKC normalisation, the one step Spark has no named built-in for.

Spark 4 ships ICU4J (it backs collations), so NFKC stays in the JVM through
the built-in ``reflect`` SQL function calling ICU's static
``Normalizer.compose(text, compat=true)``. It is only evaluated for values
holding a non-ASCII character, which NFKC alone can change; ASCII rows pay
one regex test. No Python worker is involved.

ICU 77 implements Unicode 16, Python 3.13's ``unicodedata`` Unicode 15.1:
results differ only for characters first assigned in Unicode 16.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"


def nfkc(c: Column) -> Column:
    """NFKC of a string column (null stays null)."""
    folded = F.reflect(F.lit(_ICU_NORMALIZER), F.lit("compose"), c, F.lit(True))
    return F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c)
