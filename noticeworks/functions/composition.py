"""Unicode canonical composition (NFC) of any script, as a native expression."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Nothing up to this one is a mark or has another composed form.
_PLAIN = r"\x00-\x{2ff}"
_S = 0xAC00


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[dict[str, str], dict[str, int], dict[str, str]]:
    """Full decompositions, combining classes other than 0, and pairs with their composition; without Hangul.

    Of Python's ``unicodedata``; what the composer gives is compared with them.
    """
    apart, classes, pairs = {}, {}, {}
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        if 0xD800 <= point <= 0xDFFF or _S <= point < _S + 11172:
            continue
        if unicodedata.combining(c):
            classes[c] = unicodedata.combining(c)
        whole = unicodedata.normalize("NFD", c)
        if whole != c:
            apart[c] = whole
            parts = unicodedata.decomposition(c).split(" ")
            if len(parts) == 2 and unicodedata.normalize("NFC", c) == c:
                pairs["".join(chr(int(p, 16)) for p in parts)] = c
    return apart, classes, pairs


def nfc_any(c: Column) -> Column:
    """Canonical composition. Text of plain letters is returned as it is, other text goes through the composer
    of ICU, which Spark brings along for its collations: whole texts at once, one pass over each."""
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    return F.when(c.rlike(rf"[^{_PLAIN}]"), composed).otherwise(c)
