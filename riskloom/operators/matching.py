"""Match of differently spelled names to a canonical list.

Both sides are reduced to distinct keys first. Equal names are matched by an equi-join. What is left is scored block
by block: names and candidates are hashed into blocks of bounded size, every pair of blocks is one group, and a group
returns at most two rows per name, which are then reduced per name. No pair is ever emitted, nothing is collected,
and the result does not depend on how many blocks there are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.functions.text import clean_key, compare_text, literal_map
from riskloom.operators.similarity import Block
from riskloom.session import stored, together
from riskloom.vocabulary import MATCH_THRESHOLD

NAMES_PER_BLOCK = 4096
CANDIDATES_PER_BLOCK = 4096
_RANK_SEPARATOR = "\u0001"


def canonical_names(
    entities: DataFrame, name: str = "country", order: Sequence[str] = ("iso3", "country")
) -> DataFrame:
    """Distinct keys of the canonical names; ``rank`` is the place of their first row in the order of ``order``."""
    rank = F.concat_ws(_RANK_SEPARATOR, *[F.col(c).cast("string") for c in order])
    # distinct rows first: a name is cleaned once, not once per period
    distinct = entities.select(*dict.fromkeys([name, *order])).dropna(subset=[name]).distinct()
    return (
        distinct.select(clean_key(F.col(name)).alias("canonical"), rank.alias("rank"))
        .groupBy("canonical")
        .agg(F.min("rank").alias("rank"))
        .withColumn("compared", compare_text(F.col("canonical")))
    )


def distinct_spellings(*sides: tuple[DataFrame, str]) -> DataFrame:
    """Distinct texts in the given columns with their cleaned ``name``; each spelling is cleaned once."""
    texts = [df.select(F.col(c).cast("string").alias("spelling")) for df, c in sides]
    merged = texts[0]
    for more in texts[1:]:
        merged = merged.unionByName(more)
    return merged.filter(F.col("spelling").isNotNull()).distinct().withColumn("name", clean_key(F.col("spelling")))


def distinct_names(spellings: DataFrame) -> DataFrame:
    """Distinct cleaned names in the form they are compared in."""
    return spellings.select("name").distinct().withColumn("compared", compare_text(F.col("name")))


def _best_in_block(threshold: float):
    def run(names: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        ranked = candidates.sort_values("rank", kind="stable")
        keys, ranks = ranked["canonical"].tolist(), ranked["rank"].tolist()
        block = Block(ranked["compared"].tolist())
        rows = [
            (name, keys[i], ranks[i], score)
            for name, text in zip(names["name"], names["compared"])
            for score, i in block.best_two(text, threshold)
        ]
        found = pd.DataFrame(rows, columns=["name", "canonical", "rank", "score"])
        return found.astype({"name": object, "canonical": object, "rank": object, "score": "float64"})

    return run


def _block_ids(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


_SCORED = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("canonical", T.StringType()),
     T.StructField("score", T.DoubleType()), T.StructField("runner_up", T.StringType()),
     T.StructField("runner_up_score", T.DoubleType())]
)


def scored_matches(names: DataFrame, canonical: DataFrame, threshold: float = MATCH_THRESHOLD) -> DataFrame:
    """Best candidate and runner-up per name at or above ``threshold``; of equal scores the lower rank wins.

    Both inputs are stored tables of distinct keys, so counting them is cheap.
    """
    n_names, n_candidates = names.count(), canonical.count()
    if n_names == 0 or n_candidates == 0:
        return names.sparkSession.createDataFrame([], _SCORED)
    workers = names.sparkSession.sparkContext.defaultParallelism
    name_blocks = max(1, math.ceil(n_names / NAMES_PER_BLOCK), min(workers, math.ceil(n_names / 64)))
    candidate_blocks = max(1, math.ceil(n_candidates / CANDIDATES_PER_BLOCK))
    # an explicit number of partitions: the rows are few bytes but much work, and must not be coalesced
    partitions = min(name_blocks * candidate_blocks, 20_000)
    block = ["name_block", "candidate_block"]

    left = (
        names.select("name", "compared")
        .withColumn("name_block", F.pmod(F.xxhash64("name"), F.lit(name_blocks)))
        .withColumn("candidate_block", F.explode(_block_ids(candidate_blocks)))
        .repartition(partitions, *block)
    )
    right = (
        canonical.select("canonical", "rank", "compared")
        .withColumn("candidate_block", F.pmod(F.xxhash64("canonical"), F.lit(candidate_blocks)))
        .withColumn("name_block", F.explode(_block_ids(name_blocks)))
        .repartition(partitions, *block)
    )
    best = (
        left.groupBy(*block)
        .cogroup(right.groupBy(*block))
        .applyInPandas(_best_in_block(threshold), "name string, canonical string, rank string, score double")
    )
    # at most two rows per name and candidate block
    places = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("order"), "rank", "canonical", "score")))
    return best.groupBy("name").agg(places.alias("places")).select(
        "name",
        F.col("places")[0]["canonical"].alias("canonical"),
        F.col("places")[0]["score"].alias("score"),
        F.try_element_at("places", F.lit(2))["canonical"].alias("runner_up"),
        F.try_element_at("places", F.lit(2))["score"].alias("runner_up_score"),
    )


def match_audit(
    names: DataFrame,
    canonical: DataFrame,
    threshold: float = MATCH_THRESHOLD,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """How each distinct name was matched: candidate, score, method and runner-up.

    ``names`` comes from :func:`distinct_names` and ``canonical`` from :func:`canonical_names`. With ``aliases`` a
    listed spelling is replaced before it is compared, which overrides the score.
    """
    return _audit(names, stored(canonical, "canonical"), threshold, aliases)


def _audit(
    names: DataFrame, canonical: DataFrame, threshold: float, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    if aliases:
        alias = F.try_element_at(literal_map(aliases), F.col("name"))
        names = names.withColumn("aliased", alias.isNotNull()).withColumn(
            "compared", compare_text(F.coalesce(alias, F.col("name")))
        )
    else:
        names = names.withColumn("aliased", F.lit(False))

    first = canonical.filter(F.col("compared") != "").groupBy("compared").agg(
        F.min_by("canonical", "rank").alias("canonical")
    )
    equal = stored(names.join(first, "compared", "left"), "equal-names")
    rest = equal.filter(F.col("canonical").isNull()).select("name", "compared")
    scored = scored_matches(rest, canonical, threshold)

    matched = equal.filter(F.col("canonical").isNotNull()).select(
        "name",
        "canonical",
        F.lit(100.0).alias("score"),
        F.when(F.col("aliased"), "alias").otherwise("equal").alias("method"),
        F.lit(None).cast("string").alias("runner_up"),
        F.lit(None).cast("double").alias("runner_up_score"),
    )
    unequal = rest.select("name").join(scored, "name", "left").select(
        "name",
        "canonical",
        "score",
        F.when(F.col("canonical").isNull(), "none").otherwise("scored").alias("method"),
        "runner_up",
        "runner_up_score",
    )
    return matched.unionByName(unequal)


def spelling_keys(
    spellings: DataFrame, canonical: DataFrame, threshold: float = MATCH_THRESHOLD, output: str = "join_key"
) -> DataFrame:
    """Join key per spelling: the matched candidate, or the cleaned name itself, which then joins to nothing.

    The table is stored: the rows it is joined to need no cleaning, and the planner sees whether it is small.
    """
    spellings, canonical = together(
        lambda: stored(spellings, "spellings"), lambda: stored(canonical, "canonical")
    )
    keys = _audit(distinct_names(spellings), canonical, threshold).select(
        "name", F.coalesce("canonical", "name").alias(output)
    )
    return stored(spellings.join(keys, "name").select("spelling", output), "spelling-keys")


def with_key(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Add the join key of the spelling in ``column``, null for a null."""
    return df.join(keys.withColumnRenamed("spelling", column), column, "left")


def match_to_canonical(
    df: DataFrame, column: str, entities: DataFrame, canonical_column: str, order: Sequence[str],
    threshold: float = MATCH_THRESHOLD, output: str = "join_key",
) -> DataFrame:
    """Add to ``df`` the key of the canonical name that ``column`` matches best."""
    canonical = canonical_names(entities, canonical_column, order)
    return with_key(df, column, spelling_keys(distinct_spellings((df, column)), canonical, threshold, output))
