"""Questions the star schema answers: profiles by place and month, rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statewise.operators.lookup import join_dimension, join_lookup
from statewise.operators.ordering import percent_ranks
from statewise.workspace import settle


def summary_in_range(
    facts: DataFrame,
    when: str,
    first: object,
    last: object,
    by: Sequence[str],
    measure: str,
) -> DataFrame:
    """Count, mean, least and greatest of a measure, by group, in a date range."""
    return (
        facts.where(F.col(when).between(F.lit(first), F.lit(last)))
        .groupBy(*by)
        .agg(
            F.count(measure).alias("n"),
            F.avg(measure).alias("mean"),
            F.min(measure).alias("least"),
            F.max(measure).alias("greatest"),
        )
    )


def total_by_month(
    facts: DataFrame, by: Sequence[str], year: Column, month: Column, measure: Column
) -> DataFrame:
    """Total of a measure by group, year and month."""
    return facts.groupBy(*by, year.alias("year"), month.alias("month")).agg(
        F.sum(measure).alias("total"), F.count("*").alias("n")
    )


def facts_by_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Totals of facts by attributes of a small dimension.

    The dimension comes to the facts, which are shuffled only as partial totals.
    """
    joined = join_dimension(facts, dimension, keys)
    return joined.groupBy(*by).agg(*[total.alias(name) for name, total in totals.items()])


def one_place_per_name(cities: DataFrame) -> DataFrame:
    """The most populous place of each (city, state), so that facts joined by
    name do not multiply."""
    rest = [name for name in cities.columns if name not in ("city", "state")]
    main = F.max_by(
        F.struct(*rest), F.struct("population", (-F.col("city_id")).alias("first"))
    )
    return (
        cities.groupBy("city", "state")
        .agg(main.alias("main"))
        .select("city", "state", "main.*")
    )


def place_profiles(
    cities: DataFrame,
    weather: DataFrame,
    employment: DataFrame,
    first: object,
    last: object,
) -> DataFrame:
    """One row per place: mean temperature in a range and the state's latest
    employment. Facts are reduced to their key before they meet the places."""
    climate = summary_in_range(weather, "date", first, last, ["city", "state"], "avg_temp")
    climate = climate.select("city", "state", F.col("mean").alias("mean_temp"))
    # Reduced to the months first, so that both steps aggregate by hashing.
    by_month = (
        employment.where(F.col("people_employed").isNotNull())
        .groupBy("state", (F.col("year") * 12 + F.col("month")).alias("at"))
        .agg(F.max("people_employed").alias("people"))
    )
    jobs = by_month.groupBy("state").agg(F.max_by("people", "at").alias("people_employed"))
    places = one_place_per_name(cities)
    return join_lookup(places, settle(jobs, "jobs"), ["state"], "left").join(
        climate, ["city", "state"], "left"
    )


def rank_places(
    places: DataFrame, weights: Mapping[str, float], tie: str, top: int
) -> DataFrame:
    """The ``top`` places by weighted percent ranks, best first.

    A negative weight prefers small values. A place without a value gets 0 for
    it. Adds ``score`` (six decimals) and ``place_rank``; equal scores share a
    rank and are listed by ``tie``.
    """
    ranked = percent_ranks(places, list(weights))
    parts = []
    for value, weight in weights.items():
        rank = F.col(f"{value}_rank")
        preferred = rank if weight >= 0 else 1 - rank
        parts.append(F.coalesce(preferred, F.lit(0.0)) * abs(weight))
    score = F.round(reduce(lambda a, b: a + b, parts), 6)
    best = (
        ranked.withColumn("score", score)
        .orderBy(F.desc("score"), tie)
        .limit(top)
    )
    # At most `top` rows are left, and all with a better score are among them.
    return best.withColumn("place_rank", F.rank().over(W.orderBy(F.desc("score")))).drop(
        *[f"{value}_rank" for value in weights]
    )
