"""One person under several given-name spellings: prefix links, then connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.session import checkpointed, growing, stored

# Generational suffixes. A name that adds one is another person.
GENERATIONS = ["JR", "SR", "II", "III", "IV", "V"]
MIN_SHORT = 3


def name_profiles(rows: DataFrame, family: Sequence[str], given: str, year: str) -> DataFrame:
    """Each given name of a family with the cycles it occurs in."""
    return rows.groupBy(*family, given).agg(F.collect_set(year).alias("years"))


def middle_words(rows: DataFrame, family: Sequence[str], given: str, middle: str) -> DataFrame:
    """Distinct middle-name words of more than one letter, one row each."""
    return rows.select(*family, given, F.explode(F.split(F.col(middle), " ")).alias("word")) \
        .filter(F.length("word") > 1).distinct()


def prefix_links(profiles: DataFrame, words: DataFrame, family: Sequence[str],
                 given: str) -> DataFrame:
    """Pairs (short, long) of one family that are spellings of one given name.

    A long name is met with its own prefixes by an equi-join, so names that share nothing are
    never compared. A short form is ambiguous when some extension of it is neither a prefix nor an
    extension of the long form; that is a matter of counts, with no third name in the join.

    Pairs are read many times, so they are stored twice: the plan would else hold everything before
    them once for each reader of each reader, and the driver all of it.
    """
    keys = list(family)
    lengths = F.sequence(F.lit(MIN_SHORT), F.length(given) - 1)
    extended = profiles.filter(F.length(given) > MIN_SHORT).select(
        *keys, F.col(given).alias("long"), F.col("years").alias("long_years"),
        F.explode(F.transform(lengths, lambda k: F.substr(F.col(given), F.lit(1), k)))
        .alias("short"))
    shorts = profiles.select(*keys, F.col(given).alias("short"),
                             F.col("years").alias("short_years"))
    pairs = stored(extended.join(growing(shorts), [*keys, "short"]))
    extensions = pairs.groupBy(*keys, "short").agg(F.count(F.lit(1)).alias("n_short"))
    # Lengths of the prefixes each long name has among the names; fewer than its letters.
    chain = pairs.groupBy(*keys, "long").agg(F.collect_list(F.length("short")).alias("chain"))
    of_long = extensions.select(*keys, F.col("short").alias("long"),
                                F.col("n_short").alias("n_long"))
    counted = pairs.join(growing(extensions), [*keys, "short"]).join(growing(of_long), [*keys, "long"], "left") \
        .join(growing(chain), [*keys, "long"])
    between = F.size(F.filter("chain", lambda n: n > F.length("short")))
    comparable = F.lit(1) + between + F.coalesce("n_long", F.lit(0))
    rest = F.substr("long", F.length("short") + 1)
    plausible = stored(counted.filter(
        ~rest.isin(GENERATIONS)
        & (rest != F.col("short"))
        & (F.col("n_short") <= comparable)
        & ~F.arrays_overlap("short_years", "long_years")).select(*keys, "short", "long"))
    # Middles conflict when both names have some and share none.
    short_words = growing(words.withColumnRenamed(given, "short"))
    long_words = growing(words.withColumnRenamed(given, "long"))
    both = plausible.join(short_words, [*keys, "short"], "left_semi") \
        .join(long_words, [*keys, "long"], "left_semi")
    sharing = plausible.join(short_words, [*keys, "short"]) \
        .join(long_words, [*keys, "long", "word"], "left_semi").select(*keys, "short", "long")
    conflicting = both.join(sharing, [*keys, "short", "long"], "left_anti")
    return plausible.join(growing(conflicting), [*keys, "short", "long"], "left_anti")


def components(links: DataFrame, family: Sequence[str], a: str, b: str) -> DataFrame:
    """(family, name, root): the least name each linked name is connected to.

    Labels spread along the links until none changes; each round is checkpointed. Only names with
    a link take part. A round also follows the label of the label, so long chains halve.
    """
    keys = list(family)
    edges = checkpointed(
        links.select(*keys, F.col(a).alias("src"), F.col(b).alias("dst"))
        .unionByName(links.select(*keys, F.col(b).alias("src"), F.col(a).alias("dst")))
        .distinct())
    labels = edges.groupBy(*keys, F.col("src").alias("name")).agg(
        F.least(F.col("name"), F.min("dst")).alias("root"))
    labels = checkpointed(labels)
    while True:
        heard = edges.join(labels.withColumnRenamed("name", "dst"), [*keys, "dst"]) \
            .groupBy(*keys, F.col("src").alias("name")).agg(F.min("root").alias("heard"))
        jump = labels.select(*keys, F.col("name").alias("root"), F.col("root").alias("up"))
        step = labels.join(heard, [*keys, "name"]).join(jump, [*keys, "root"], "left").select(
            *keys, "name", F.col("root").alias("old"),
            F.least("root", "heard", F.coalesce("up", "root")).alias("root"))
        step = checkpointed(step)
        changed = step.filter(F.col("old") != F.col("root")).limit(1).count()
        labels = step.drop("old")
        if not changed:
            return labels


def same_person_names(rows: DataFrame, family: Sequence[str], given: str, year: str, middle: str,
                      curated: DataFrame | None = None, out: str = "person_given") -> DataFrame:
    """(family, given, out): the canonical spelling of every given name that has another one.

    ``curated``: family columns, ``a``, ``b`` - hand-verified pairs; they count where both names
    occur. The longest spelling stands, the alphabetically first of equally long ones. Names
    without a link are not listed; they stand for themselves.
    """
    keys = list(family)
    profiles = stored(name_profiles(rows, keys, given, year))
    words = stored(middle_words(rows, keys, given, middle))
    links = prefix_links(profiles, words, keys, given).select(
        *keys, F.col("short").alias("a"), F.col("long").alias("b"))
    if curated is not None:
        present = profiles.select(*keys, F.col(given).alias("a"))
        known = curated.select(*keys, "a", "b") \
            .join(present, [*keys, "a"], "left_semi") \
            .join(present.withColumnRenamed("a", "b"), [*keys, "b"], "left_semi")
        links = links.unionByName(known.select(*keys, "a", "b"))
    roots = components(links, keys, "a", "b")
    canon = roots.groupBy(*keys, "root").agg(
        F.min_by("name", F.struct(-F.length("name"), F.col("name"))).alias(out))
    return roots.join(canon, [*keys, "root"]).select(*keys, F.col("name").alias(given), out)


def resolve_given(rows: DataFrame, family: Sequence[str], given: str, year: str, middle: str,
                  curated: DataFrame | None = None, out: str = "person_given") -> DataFrame:
    """Rows with the canonical given name of their person."""
    canon = same_person_names(rows, family, given, year, middle, curated, "__canon")
    return rows.join(growing(canon), [*family, given], "left") \
        .withColumn(out, F.coalesce("__canon", given)).drop("__canon")
