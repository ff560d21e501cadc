"""Free-form names to stable codes: an ordered cascade of keys, then near spellings."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from hustings.session import checkpointed

CUTOFF = 0.9


def prefix_forms(key: Column) -> Column:
    """A name and then its word prefixes, longest first."""
    words = F.split(key, " ")
    n = F.size(words)
    return F.transform(F.sequence(n, F.lit(1), F.lit(-1)),
                       lambda k: F.array_join(F.slice(words, F.lit(1), k), " "))


def cascade_keys(pairs: DataFrame, scope_name: str, key: str,
                 aliases: DataFrame | None = None, prefixes: bool = True) -> DataFrame:
    """Candidate keys of each pair with their order: for each form the alias bound to the scope
    name, else the general alias, and then the form itself.

    ``aliases``: ``scope_name`` (null for a general alias), ``form``, ``alias``.
    """
    forms = prefix_forms(F.col(key)) if prefixes else F.array(F.col(key))
    long = pairs.select("*", F.posexplode(forms).alias("__pos", "__form"))
    literal = long.withColumn("__key", F.col("__form")).withColumn("__order", F.col("__pos") * 2 + 1)
    if aliases is None:
        return literal.drop("__pos", "__form")
    own = aliases.filter(F.col("scope_name").isNotNull()).select(
        F.col("scope_name").alias("__scope"), F.col("form").alias("__f"),
        F.col("alias").alias("__own"))
    general = aliases.filter(F.col("scope_name").isNull()).select(
        F.col("form").alias("__g"), F.col("alias").alias("__general"))
    aliased = long.join(own, (F.col(scope_name) == F.col("__scope"))
                        & (F.col("__form") == F.col("__f")), "left") \
        .join(general, F.col("__form") == F.col("__g"), "left") \
        .withColumn("__key", F.coalesce("__own", "__general")) \
        .filter(F.col("__key").isNotNull()).withColumn("__order", F.col("__pos") * 2)
    return literal.unionByName(aliased.select(*literal.columns)).drop("__pos", "__form")


def resolve_codes(pairs: DataFrame, scopes: DataFrame, names: DataFrame, id_cols: list[str],
                  scope_name: str, key: str, aliases: DataFrame | None = None,
                  prefixes: bool = True) -> DataFrame:
    """Code of each distinct pair: the first scope, then the first key, that meets a name.

    ``scopes``: ``scope_name``, ``scope``, ``scope_pos``. ``names``: ``scope``, ``key``, ``code``;
    where two codes share a key in a scope the greater one stands. Unresolved pairs keep a null.
    """
    targets = names.groupBy("scope", "key").agg(F.max("code").alias("code")) \
        .select(F.col("scope").alias("__scope_id"), F.col("key").alias("__name"), "code")
    candidates = cascade_keys(pairs.select(*dict.fromkeys([*id_cols, scope_name, key])), scope_name, key,
                              aliases, prefixes)
    wanted = scopes.select(F.col("scope_name").alias("__sn"), "scope", "scope_pos")
    hits = candidates.join(wanted, F.col(scope_name) == F.col("__sn")) \
        .join(targets, (F.col("scope") == F.col("__scope_id"))
              & (F.col("__key") == F.col("__name")))
    best = hits.groupBy(*id_cols).agg(
        F.min_by("code", F.struct("scope_pos", "__order")).alias("code"))
    return pairs.join(best, id_cols, "left")


@F.pandas_udf(DoubleType())
def sequence_ratio(word: pd.Series, name: pd.Series) -> pd.Series:
    """Matching-blocks similarity of each pair."""
    return pd.Series([SequenceMatcher(None, n, w).ratio() for w, n in zip(word, name)],
                     dtype="float64")


def width_of(cutoff: float) -> int:
    """Letters of a piece. Pieces of two letters tell names apart far better, but with low cutoffs
    too few of them need be shared."""
    return 2 if cutoff >= 0.8 else 1


def pieces_of(text: Column, width: int) -> Column:
    """The pieces of a text: its letters, or its neighbouring letters with the two ends; each with
    how often it has come so far, so two texts share as many pieces as they do with repetitions."""
    padded = text if width == 1 else F.concat(F.lit("\x01"), text, F.lit("\x02"))
    plain = F.transform(F.sequence(F.lit(1), F.length(padded) - (width - 1)), lambda i: F.substr(padded, i, F.lit(width)))
    return F.transform(plain, lambda c, i: F.concat(
        c, F.size(F.filter(F.slice(plain, F.lit(1), i + 1), lambda o: o == c)).cast("string")))


def rarest_first(texts: DataFrame, names: DataFrame, text: str, width: int) -> DataFrame:
    """(text, pieces): the pieces of each text, the rarest among ``names`` first."""
    counts = names.select(F.explode(pieces_of(F.col(text), width)).alias("__piece")) \
        .groupBy("__piece").agg(F.count(F.lit(1)).alias("__n"))
    long = texts.select(text, F.explode(pieces_of(F.col(text), width)).alias("__piece"))
    return long.join(counts, "__piece", "left").groupBy(text).agg(F.transform(
        F.sort_array(F.collect_list(F.struct(F.coalesce("__n", F.lit(0)), "__piece"))),
        lambda p: p["__piece"]).alias("pieces"))  # as many as the text has letters, and one


def least_shared(joint: Column, cutoff: float) -> Column:
    """How many pieces two texts of this joint length must share to reach the cutoff: half the
    matched letters, or the matched neighbours, of which every other letter parts two at most."""
    least = joint * (cutoff / 2) if width_of(cutoff) == 1 else joint * (1.5 * cutoff - 1) + 1
    return F.ceil(least - 1e-9)


def rare_pairs(texts: DataFrame, text: str, cutoff: float) -> DataFrame:
    """``texts`` (with pieces) with all pairs of their rarest pieces, as many as it takes for two
    texts that reach the cutoff to have a pair in common."""
    length = F.length(text)
    shortest = F.ceil(length * (cutoff / (2.0 - cutoff)) - 1e-9)  # partner
    # one more piece that all texts have, and behind all others, makes a pair out of one piece
    rare = F.slice(F.concat("pieces", F.array(F.lit(""))), F.lit(1),
                   (F.size("pieces") - least_shared(length + shortest, cutoff) + 2).cast("int"))
    pairs = F.flatten(F.transform("__rare", lambda a, i: F.transform(
        F.slice("__rare", i + 2, F.size("__rare")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return texts.withColumn("__rare", rare).withColumn("__pair", F.explode(pairs))


def near_candidates(words: DataFrame, targets: DataFrame, scope: str, text: str,
                    cutoff: float) -> DataFrame:
    """(scope, text, near): pairs of a word and a name of its scope that may reach the cutoff.

    To reach it two texts must share a number t of pieces. Pieces are ordered by how rare they are
    among the names; of two texts that share t pieces the rarest n - t + 2 of each have a pair of
    pieces in common, and an inverted index over these pairs finds them. Pieces that most names
    have stand last and index next to nothing. A pair of texts is taken at the first pair of pieces
    that they share, so none comes twice.
    """
    both = targets.select(text).unionByName(words.select(text)).filter(F.length(text) > 0).distinct()
    pieces = checkpointed(rarest_first(both, targets.select(text).distinct(), text, width_of(cutoff)))
    probe = rare_pairs(words.select(scope, text).distinct().join(pieces, text), text, cutoff)
    index = rare_pairs(targets.select(scope, text).distinct().join(pieces, text), text, cutoff) \
        .select(F.col(scope).alias("__scope"), F.col(text).alias("near"), F.col("pieces").alias("__pieces"),
                F.col("__rare").alias("__others"), F.col("__pair").alias("__key"))
    met = probe.join(index, (F.col(scope) == F.col("__scope")) & (F.col("__pair.a") == F.col("__key.a"))
                     & (F.col("__pair.b") == F.col("__key.b")))
    first = F.slice(F.array_intersect("__rare", "__others"), 1, 2)
    joint = F.length(text) + F.length("near")
    unlike = F.floor(F.lit(1.0 - cutoff) * joint + 1e-9)
    return met.filter(first == F.array("__pair.a", "__pair.b")) \
        .filter(F.size(F.array_intersect("pieces", "__pieces")) >= least_shared(joint, cutoff)) \
        .filter(F.levenshtein(text, "near") <= unlike).select(scope, text, "near")


def near_spellings(pairs: DataFrame, scopes: DataFrame, names: DataFrame, id_cols: list[str],
                   scope_name: str, key: str, cutoff: float = CUTOFF) -> DataFrame:
    """Best name at or above ``cutoff`` for each pair within its scopes: ``code``, ``near``,
    ``ratio``. The first scope with a hit wins; equal ratios go to the greater name. Any cutoff
    above 0 is covered; a lower one has more candidates."""
    if not 0 < cutoff <= 1:
        raise ValueError("the cutoff lies above 0, and 1 at most")
    targets = names.groupBy("scope", "key").agg(F.max("code").alias("code")) \
        .select(F.col("scope").alias("__scope_id"), F.col("key").alias("__text"), "code")
    wanted = scopes.select(F.col("scope_name").alias("__sn"), F.col("scope").alias("__scope_id"), "scope_pos")
    asked = pairs.select(*dict.fromkeys([*id_cols, scope_name, key])) \
        .join(wanted, F.col(scope_name) == F.col("__sn")).withColumn("__text", F.col(key))
    candidates = near_candidates(asked, targets, "__scope_id", "__text", cutoff)
    scored = candidates.withColumn("ratio", sequence_ratio("__text", "near")) \
        .filter(F.col("ratio") >= cutoff)
    known = scored.join(targets.withColumnRenamed("__text", "near"), ["__scope_id", "near"])
    order = F.struct(-F.col("scope_pos"), F.col("ratio"), F.col("near"))
    return asked.join(known, ["__scope_id", "__text"]).groupBy(*id_cols).agg(
        F.max_by(F.struct("code", "near", "ratio"), order).alias("__hit")) \
        .select(*id_cols, "__hit.code", "__hit.near", "__hit.ratio")


def crosswalk(pairs: DataFrame, scopes: DataFrame, names: DataFrame, id_cols: list[str],
              scope_name: str, key: str, aliases: DataFrame | None = None,
              cutoff: float | None = CUTOFF) -> DataFrame:
    """Distinct pairs with ``code`` and ``how`` (``exact``, ``near`` or null)."""
    exact = resolve_codes(pairs, scopes, names, id_cols, scope_name, key, aliases) \
        .withColumn("how", F.when(F.col("code").isNotNull(), F.lit("exact")))
    if cutoff is None:
        return exact
    exact = checkpointed(exact)
    open_pairs = exact.filter(F.col("code").isNull()).drop("code", "how")
    if open_pairs.isEmpty():
        return exact.withColumns({"near": F.lit(None).cast("string"), "ratio": F.lit(None).cast("double")})
    near = near_spellings(open_pairs, scopes, names, id_cols, scope_name, key, cutoff) \
        .select(*id_cols, F.col("code").alias("__near"), "near", "ratio")
    return exact.join(near, id_cols, "left").withColumn(
        "how", F.coalesce("how", F.when(F.col("__near").isNotNull(), F.lit("near")))) \
        .withColumn("code", F.coalesce("code", "__near")).drop("__near")


def first_known_variant(df: DataFrame, id_cols: list[str], variants: str,
                        known: DataFrame, known_key: str) -> DataFrame:
    """First of a row's ordered variants that is among the known keys, null when none is."""
    long = df.select(*id_cols, F.posexplode(variants).alias("__pos", "__variant"))
    keys = known.select(F.col(known_key).alias("__variant")).distinct()
    hits = long.join(keys, "__variant", "left_semi").groupBy(*id_cols).agg(
        F.min_by("__variant", "__pos").alias("variant"))
    return df.join(hits, id_cols, "left")
