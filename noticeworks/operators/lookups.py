"""Joins against reference data.

No side is forced to be broadcast: the optimizer does so below its size threshold
and adaptive execution splits hot keys above it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import config
from noticeworks.functions import names
from noticeworks.functions.text import SPACE, compose, lookup

Keys = Sequence[tuple[str, Callable[[Column], Column]]]


def unique_dimension(dim: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per key, the last in order."""
    others = [c for c in dim.columns if c != key]
    return dim.groupBy(key).agg(
        F.max_by(F.struct(*others), F.col(order or others[0])).alias("_v")
    ).select(key, "_v.*")


def enrich_lookup(records: DataFrame, dim: DataFrame, source_field: str, key: str,
                  mappings: Mapping[str, str]) -> DataFrame:
    """Adds dimension columns under their target names; unknown names get nulls."""
    wanted = dim.select(F.col(key).alias(source_field),
                        *[F.col(c).alias(t) for c, t in mappings.items()])
    return records.join(unique_dimension(wanted, source_field), source_field, "left")


def resolve_by_keys(facts: DataFrame, name: str, dim: DataFrame, dim_name: str, value: str,
                    fact_keys: Keys, dim_keys: Keys, result: str) -> DataFrame:
    """Value of the first key of a name that the dimension knows, null when none does.

    Keys are ``(space, function)`` pairs and match within their space.  The distinct
    names are resolved once and joined back, so the facts meet one small table.
    """
    def exploded(df: DataFrame, column: str, keys: Keys, *extra: Column) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(s).alias("space"), f(F.col(column)).alias("key")) for s, f in keys])
        return df.select(F.col(column), *extra, F.posexplode(pairs).alias("rank", "k")).select(
            column, *[c for c in ("_value",) if extra], "rank", "k.space", "k.key")

    known = exploded(
        dim.where(F.col(value).isNotNull()), dim_name, dim_keys, F.col(value).alias("_value")
    ).groupBy("space", "key").agg(F.max_by("_value", F.struct(F.col(dim_name), F.col("_value"))).alias("_value"))
    asked = exploded(facts.where(F.col(name).isNotNull()).select(name).distinct(), name, fact_keys)
    answers = asked.join(known, ["space", "key"]).groupBy(name).agg(F.min_by("_value", "rank").alias(result))
    return facts.join(answers, name, "left")


def _same(c: Column) -> Column:
    return c


def resolve_canonical_name(records: DataFrame, name: str, dim: DataFrame, dim_name: str) -> DataFrame:
    """Reference spelling of a name: exact, suffix-stripped, fully normalised, else unchanged."""
    resolved = resolve_by_keys(
        records, name, dim.select(dim_name, F.col(dim_name).alias("_canonical")), dim_name, "_canonical",
        fact_keys=[("name", _same), ("name", names.strip_municipality_suffix),
                   ("normal", names.normalize_municipality)],
        dim_keys=[("name", _same), ("normal", names.normalize_municipality)],
        result="_resolved",
    )
    return resolved.withColumn("canonical", F.coalesce("_resolved", name)).drop("_resolved")


def _ascii_without_suffix(c: Column) -> Column:
    c = F.regexp_replace(names.normalize_to_ascii(c), rf"(?iu){SPACE}*kommun\z", "")
    return F.regexp_replace(c, rf"(?iu){SPACE}*stad\z", "")


def _composed_lower(c: Column) -> Column:
    return F.lower(compose(c))


def multi_key_lookup(facts: DataFrame, name: str, dim: DataFrame, dim_name: str, value: str) -> DataFrame:
    """Home page by exact, ASCII-folded or composed lower-case name."""
    return resolve_by_keys(
        facts, name, dim, dim_name, value,
        fact_keys=[("any", _same), ("any", names.normalize_to_ascii), ("any", _composed_lower)],
        dim_keys=[("any", _same), ("any", _ascii_without_suffix), ("any", _composed_lower)],
        result="homepage",
    )


def _dashed_ascii(c: Column) -> Column:
    dashed = F.regexp_replace(F.regexp_replace(names.normalize_to_ascii(c), "[^a-z0-9]", "-"), "-+", "-")
    return F.regexp_replace(dashed, r"^-|-\z", "")


def display_name_lookup(facts: DataFrame, ident: str, dim: DataFrame, dim_name: str) -> DataFrame:
    """Proper name of an id by exact, sanitised or lower-case key, else the id."""
    found = resolve_by_keys(
        facts, ident, dim.select(dim_name, F.col(dim_name).alias("_display")), dim_name, "_display",
        fact_keys=[("any", _same), ("any", F.lower)],
        dim_keys=[("any", _dashed_ascii), ("any", _composed_lower), ("any", _same)],
        result="_found",
    )
    return found.withColumn("display_name", F.coalesce("_found", ident)).drop("_found")


def match_seed_to_source(seeds: DataFrame, name: str, sources: DataFrame, source_name: str) -> DataFrame:
    """Configured source of a listed name: normalised, alias, or genitive s dropped."""
    def alias(c: Column) -> Column:
        return lookup(names.normalize_municipality(c), config.NAME_ALIASES)

    def stem(c: Column) -> Column:
        n = names.normalize_municipality(c)
        return F.when(n.endswith("s") & (F.length(n) > 3), F.regexp_replace(n, r"s\z", ""))

    return resolve_by_keys(
        seeds, name, sources.select(source_name, F.col(source_name).alias("_match")), source_name, "_match",
        fact_keys=[("n", names.normalize_municipality), ("n", alias), ("n", stem)],
        dim_keys=[("n", names.normalize_municipality)],
        result="matched_source",
    )


def population_join(counts: DataFrame, source: str, population: DataFrame) -> DataFrame:
    """Counts of the sources whose id is the sanitised name of a listed place."""
    keyed = population.select(
        names.sanitize_ascii_name(F.col("name")).alias(source), F.col("name").alias("place"), "inhabitants")
    return counts.join(keyed, source)


def org_name_lookup(properties: DataFrame, organizations: DataFrame) -> DataFrame:
    named = organizations.select("organization_id", F.col("name").alias("organization_name"))
    return properties.join(named, "organization_id", "left")


def in_set_flag(rows: DataFrame, key: str, members: DataFrame, member: str, flag: str, scope: Sequence[str] = ()) -> DataFrame:
    """Adds whether the key is in the set, or in the part of it with the row's ``scope``."""
    found = members.select(*scope, F.col(member).alias(key)).distinct().withColumn(flag, F.lit(True))
    return rows.join(found, [*scope, key], "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def type_name_lookup(notices: DataFrame, types: DataFrame, key: str = "type_key", board: str = "board_id") -> DataFrame:
    """Name of a notice type on its board by its number, then by its GUID, else empty."""
    coded = types.select(
        board, F.explode(F.array(
            F.struct(F.lit(0).alias("rank"), F.col("type").alias("code")),
            F.struct(F.lit(1).alias("rank"), F.col("id").alias("code")),
        )).alias("k"), F.col("name")
    ).where(F.col("k.code").isNotNull())
    by_code = coded.groupBy(board, F.col("k.code").alias(key)).agg(F.min_by("name", F.struct("k.rank", "name")).alias("type_name"))
    return notices.join(by_code, [board, key], "left").withColumn("type_name", F.coalesce("type_name", F.lit("")))


def sources_without_data(sources: DataFrame, records: DataFrame, key: str = "source") -> DataFrame:
    return sources.join(records.select(key).distinct(), key, "left_anti")


def notices_by_org(organizations: DataFrame, tenders: DataFrame) -> DataFrame:
    return organizations.join(tenders, "organization_id")


def mangled_to_reference(configs: DataFrame, reference: DataFrame) -> DataFrame:
    """Mangled names with the reference name that has the same letters."""
    keyed = reference.groupBy(names.letters_key(F.col("name")).alias("letters")).agg(
        F.min("name").alias("reference_name"))
    mangled = configs.where(names.is_mangled_name(F.col("name")))
    return (
        mangled.withColumn("letters", names.letters_key(F.col("name")))
        .join(keyed, "letters").where(F.col("reference_name") != F.col("name")).drop("letters")
    )


def expected_vs_actual(expected: DataFrame, actual: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Expected records with, per field, whether the extracted record agrees."""
    def key(c: str) -> Column:
        return F.lower(F.regexp_replace(c, rf"{SPACE}+", ""))

    # the fields of one record: of several with the same number the smallest
    got = actual.where(F.col("case_number").isNotNull()).groupBy(key("case_number").alias("_key")).agg(
        F.min(F.struct(*fields)).alias("_actual"))
    joined = expected.withColumn("_key", key("case_number")).join(got.withColumn("found", F.lit(True)), "_key", "left")
    return joined.select(
        "case_number", F.coalesce("found", F.lit(False)).alias("found"),
        *[(F.coalesce("found", F.lit(False)) & F.col(f).eqNullSafe(F.col("_actual")[f])).alias(f"{f}_ok") for f in fields],
    )
