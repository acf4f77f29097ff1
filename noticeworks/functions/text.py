"""String helpers shared by the column functions; all are native expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as the sources' own tooling sees it: ASCII plus no-break space and BOM.
SPACE = r"[\s\u00a0\ufeff]"
_SPACE_CHARS = " \t\n\x0b\f\r\u00a0\ufeff"

# Letter + combining mark pairs and their composed letters.
COMPOSED = {
    "a\u030a": "å", "a\u0308": "ä", "o\u0308": "ö", "e\u0301": "é", "u\u0308": "ü",
    "A\u030a": "Å", "A\u0308": "Ä", "O\u0308": "Ö", "E\u0301": "É", "U\u0308": "Ü",
}


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated once however often ``use`` mentions it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds costly columns that later filters must not evaluate a second time.

    Filters on plain columns are pushed below the projection with the expression
    copied into them; they stop at a generator.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    rest = [c for c in df.columns if c not in columns]
    return df.select("*", F.explode(F.array(made)).alias("_made")).select(
        *rest, *[F.col(f"_made.{name}").alias(name) for name in columns])


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE_CHARS))


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"{SPACE}+", " "))


def compose(c: Column) -> Column:
    """Canonical composition of the letters Swedish names are written with."""
    composed = c
    for pair, letter in COMPOSED.items():
        composed = F.replace(composed, F.lit(pair), F.lit(letter))
    return F.when(c.rlike(r"[\u0301\u0308\u030a]"), composed).otherwise(c)


def fold(c: Column) -> Column:
    """Lower case with å ä ö é ü written as ASCII letters."""
    c = F.lower(compose(c))
    for letter, plain in zip("åäöéü", "aaoeu"):
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return c


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, null when the pattern or the group did not match."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def any_of(c: Column, words: Iterable[str]) -> Column:
    """Does the string contain at least one of the words?"""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(c, F.lit(word))
    return hit


def words_found(c: Column, words: Iterable[str]) -> Column:
    """The words whose lower-case form the string contains, in the order given."""
    listed = [F.struct(F.lit(w).alias("w"), F.lit(w.lower()).alias("low")) for w in words]
    found = let(c, lambda t: F.filter(F.array(*listed), lambda x: F.contains(t, x["low"])))
    return F.transform(found, lambda x: x["w"])


def round_half_up(c: Column) -> Column:
    return F.floor(c + F.lit(0.5)).cast("long")


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed table, null when the key is missing."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), c)


def one_of(c: Column, values: Iterable[str]) -> Column:
    return c.isin(*values)
