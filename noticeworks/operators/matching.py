"""Permits against properties, signals into projects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.functions import names, records
from noticeworks.functions.text import blank_to_null
from noticeworks.session import stored

_GRAM_SIZES = (1, 2, 4, 8, 16, 32)


def _anchor(needle: Column) -> Column:
    """Last 1, 2, 4 … 32 letters: the largest of these sizes the text has."""
    size = F.length(needle)
    anchor = None
    for n in reversed(_GRAM_SIZES):
        anchor = (F.when(size >= n, F.right(needle, F.lit(n))) if anchor is None
                  else anchor.when(size >= n, F.right(needle, F.lit(n))))
    return anchor


def _grams(text: Column, sizes: Column) -> Column:
    """Every distinct piece of the text that could be an anchor of one of the sizes."""
    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
        wanted = (F.length(text) >= n) & F.array_contains(sizes, n)
        return F.when(wanted, F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))).otherwise(
            F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of_size(n) for n in _GRAM_SIZES]))


def containing_pairs(left: DataFrame, text: str, right: DataFrame, needle: str, keys: list[str]) -> DataFrame:
    """Pairs with equal keys whose ``text`` contains the ``needle``.

    A containing text must have the needle's anchor among its own pieces. So pairs are found by
    an equi join on keys and piece instead of comparing everything that shares a key, and the
    containment itself is then checked on these few pairs. Only anchor sizes that
    occur under the same key are cut out, of the distinct texts; what is shuffled of a
    piece is the key and two hashes, and whole rows join only the pairs that are left.
    """
    anchored = right.withColumn("_anchor", _anchor(F.col(needle))).withColumn("_piece", F.xxhash64("_anchor"))
    sizes = anchored.groupBy(*keys).agg(F.collect_set(F.length("_anchor")).alias("_sizes"))
    pieces = left.select(*keys, text).distinct().join(sizes, keys).select(
        *keys, F.xxhash64(text).alias("_text"), F.explode(F.transform(_grams(F.col(text), F.col("_sizes")), lambda x: F.xxhash64(x))).alias("_piece"))
    hits = pieces.join(anchored.select(*keys, "_piece").distinct(), [*keys, "_piece"], "left_semi")
    pairs = hits.join(anchored.drop("_anchor"), [*keys, "_piece"]).drop("_piece")
    return left.withColumn("_text", F.xxhash64(text)).join(pairs, [*keys, "_text"]).where(
        F.contains(F.col(text), F.col(needle))).drop("_text")


def _pieces(text: Column) -> Column:
    """All pieces of a text that are as long as its anchor."""
    size = F.length(_anchor(text))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, size)))


def rarest_hits(left: DataFrame, text: str, right: DataFrame, needle: str, keys: list[str]) -> DataFrame:
    """Pairs of a text (its hash in ``_text``) and a needle whose rarest piece the text has.

    How many texts have each piece of a needle is counted first, under the same key; a piece that no
    text has rules its needle out. The pieces of the distinct texts that are pieces of some needle are stored, as
    the counts and the look-up both read them.
    """
    needles = right.select(*keys, needle).distinct().withColumn("_size", F.length(_anchor(F.col(needle))))
    asked = needles.select(*keys, needle, F.explode(F.transform(_pieces(F.col(needle)), lambda x: F.xxhash64(x))).alias("_piece"))
    sizes = needles.groupBy(*keys).agg(F.collect_set("_size").alias("_sizes"))
    cut = left.select(*keys, text).distinct().join(sizes, keys).select(
        *keys, F.xxhash64(text).alias("_text"), F.explode(F.transform(_grams(F.col(text), F.col("_sizes")), lambda x: F.xxhash64(x))).alias("_piece"))
    hits = stored(cut.join(asked.select(*keys, "_piece").distinct(), [*keys, "_piece"], "left_semi"), "pieces")
    counts = hits.groupBy(*keys, "_piece").agg(F.count("*").alias("_texts"))
    rarest = asked.join(counts, [*keys, "_piece"], "left").groupBy(*keys, needle).agg(
        F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("texts"), "_piece")).alias("_rarest"))
    anchored = rarest.where(F.col("_rarest.texts") > 0).select(*keys, needle, F.col("_rarest._piece").alias("_piece"))
    return hits.join(anchored, [*keys, "_piece"]).drop("_piece")


def containing_pairs_by_rarest(left: DataFrame, text: str, right: DataFrame, needle: str, keys: list[str]) -> DataFrame:
    """As ``containing_pairs``, for needles that end alike: each is looked up by its rarest piece."""
    pairs = rarest_hits(left, text, right, needle, keys)
    found = left.withColumn("_text", F.xxhash64(text)).join(pairs, [*keys, "_text"]).where(F.contains(F.col(text), F.col(needle)))
    return found.drop("_text").join(right, [*keys, needle])


def match_properties(permits: DataFrame, properties: DataFrame, rarest: bool = False) -> DataFrame:
    """Permits whose address contains a property's designation in the same municipality.

    With ``rarest`` designations are looked up by their rarest piece, which pays where many of a municipality end alike.
    """
    left = permits.where(
        blank_to_null(F.col("address")).isNotNull() & blank_to_null(F.col("municipality")).isNotNull()
    ).withColumns({
        "_address": F.lower("address"), "_place": names.normalize_municipality(F.col("municipality"))})
    right = properties.where(
        blank_to_null(F.col("property_designation")).isNotNull() & blank_to_null(F.col("municipality")).isNotNull()
    ).select(
        "organization_id", "property_designation", F.lower("property_designation").alias("_needle"),
        names.normalize_municipality(F.col("municipality")).alias("_place"))
    pairs = containing_pairs_by_rarest if rarest else containing_pairs
    return pairs(left, "_address", right, "_needle", ["_place"]).drop("_address", "_needle", "_place")


def permit_signals(matches: DataFrame) -> DataFrame:
    """Matched permits, with ``organization_name``, as signals; rejected ones are left out."""
    kept = matches.where(~records.is_rejected(F.col("status")))
    kind = F.coalesce(blank_to_null(F.col("permit_type")), F.lit("okänt"))
    case = blank_to_null(F.col("case_number"))

    def line(label: str, c: str) -> Column:
        return F.concat(F.lit(f"{label}: "), blank_to_null(F.col(c).cast("string")))

    excerpt = F.concat_ws(
        "\n", F.concat(F.lit("Bygglov: "), F.coalesce(blank_to_null(F.col("permit_type")), F.lit("okand typ"))),
        line("Diarienummer", "case_number"), line("Status", "status"), line("Sokande", "applicant"),
        line("Adress", "address"), line("Fastighet", "property"), line("Kommun", "municipality"),
        line("Datum", "date"), F.concat(F.lit("\n"), blank_to_null(F.col("description"))))
    return kept.select(
        "organization_id", "organization_name",
        F.concat(
            F.upper(F.left(kind, F.lit(1))), F.substr(kind, F.lit(2)), F.lit(" — "),
            F.col("property_designation"), F.coalesce(F.concat(F.lit(" ("), case, F.lit(")")), F.lit(""))).alias("title"),
        records.status_to_maturity(F.col("status")).alias("maturity"),
        F.left(blank_to_null(F.col("description")), F.lit(200)).alias("description"),
        F.coalesce(
            blank_to_null(F.col("source_url")),
            F.concat(F.lit("permit://"), F.coalesce(
                F.col("id").cast("string"), case,
                F.concat(F.col("property_designation"), F.lit("/"), F.col("municipality"))))).alias("source_url"),
        F.col("date").alias("source_date"),
        F.coalesce(blank_to_null(F.col("lan")), F.col("municipality")).alias("region"),
        F.lit("permit").alias("source_type"), excerpt.alias("source_excerpt"), "property_designation")


def assign_exact_project(signals: DataFrame, projects: DataFrame) -> DataFrame:
    """Signals with the first project of the same organisation and designation."""
    first = projects.groupBy(F.col("organization_id").alias("_org"), F.col("property_designation").alias("_prop")).agg(
        F.min("project_id").alias("matched_project"))
    same = F.col("organization_id").eqNullSafe(F.col("_org")) & (F.col("property_designation") == F.col("_prop"))
    return signals.join(first, same, "left").drop("_org", "_prop")


def group_permit_signals(signals: DataFrame, projects: DataFrame) -> DataFrame:
    """Permit signals by designation: into an existing project, a new one, or one just made.

    The first signal of a designation makes the project and gives it its title.
    """
    key = ["organization_id", "property_designation"]
    assigned = assign_exact_project(signals.where(F.col("property_designation").isNotNull()), projects)
    firsts = assigned.where(F.col("matched_project").isNull()).groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(
        F.min("arrival").alias("_first"), F.min_by("title", "arrival").alias("_title"))
    joined = assigned.join(
        firsts,
        F.col("organization_id").eqNullSafe(F.col("_organization_id"))
        & (F.col("property_designation") == F.col("_property_designation")), "left")
    return joined.select(
        "signal_id", "arrival", "title", *key,
        F.when(F.col("matched_project").isNull() & (F.col("arrival") == F.col("_first")), "new_project")
        .otherwise("grouped").alias("action"),
        F.col("matched_project").alias("project_id"),
        F.when(F.col("matched_project").isNull(), F.col("_title")).alias("new_project_title"))


def group_other_signals(signals: DataFrame, projects: DataFrame, permit_groups: DataFrame) -> DataFrame:
    """Other signals: an organisation without any project gets one from its first signal.

    All further signals need a person to choose among the projects.
    """
    owners = projects.select("organization_id").union(
        permit_groups.select("organization_id")).distinct().select(
        F.col("organization_id").alias("_org"), F.lit(True).alias("_owned"))
    firsts = signals.groupBy(F.col("organization_id").alias("_first_org")).agg(F.min("arrival").alias("_first"))
    joined = signals.join(owners, F.col("organization_id").eqNullSafe(F.col("_org")), "left").join(
        firsts, F.col("organization_id").eqNullSafe(F.col("_first_org")), "left")
    new = F.col("_owned").isNull() & (F.col("arrival") == F.col("_first"))
    return joined.select(
        "signal_id", "arrival", "title", "organization_id", F.lit(None).cast("string").alias("property_designation"),
        F.when(new, "new_project").otherwise("needs_review").alias("action"),
        F.lit(None).cast("long").alias("project_id"),
        F.when(new, F.left("title", F.lit(80))).alias("new_project_title"))


def group_signals(signals: DataFrame, projects: DataFrame) -> DataFrame:
    """Every signal without project with what happens to it; permits without designation need a person."""
    from noticeworks.operators.shaping import ungrouped_split

    permits, others = ungrouped_split(signals)
    grouped = group_permit_signals(permits, projects)
    unplaced = permits.where(F.col("property_designation").isNull()).select(
        "signal_id", "arrival", "title", "organization_id", "property_designation", F.lit("needs_review").alias("action"),
        F.lit(None).cast("long").alias("project_id"), F.lit(None).cast("string").alias("new_project_title"))
    return grouped.unionByName(group_other_signals(others, projects, grouped)).unionByName(unplaced)


def project_groups(assigned: DataFrame, project: str = "project_title") -> DataFrame:
    """Signals of every project, one row each, with the size of their group."""
    sizes = assigned.groupBy(project).agg(F.count("*").alias("signals"))
    return assigned.join(sizes, project)


def grouping_summary(grouped: DataFrame) -> DataFrame:
    return grouped.agg(
        F.count("*").alias("signals"),
        *[F.count_if(F.col("action") == a).alias(a) for a in ("grouped", "new_project", "needs_review")])


def match_summary(matches: DataFrame) -> DataFrame:
    rejected = records.is_rejected(F.col("status"))
    return matches.agg(
        F.count("*").alias("matched"), F.count_if(~rejected).alias("upserted"), F.count_if(rejected).alias("skipped"))
