"""Operators against direct pandas computations on random tables, with one hot group and missing values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators.dedup import one_per_key
from riskloom.operators.exposure import risk_trends
from riskloom.operators.rollups import aggregate_loans, aggregate_ratings
from riskloom.operators.scoring import aggregate_esg, normalise
from riskloom.operators.summary import country_summary
from riskloom.vocabulary import INDICATORS

CODES = list(INDICATORS)


def facts(rng, entities=30, hot=0.35):
    """Indicator values of which about a third are of one indicator and year."""
    rows = []
    for e in range(entities):
        for year in range(2018, 2022):
            for code in map(str, rng.choice(CODES, rng.integers(0, 8), replace=False)):
                rows.append((f"E{e:02d}", f"Entity {e}", year, code, round(float(rng.normal(50, 20)), 3)))
    rows += [(f"H{i:04d}", f"Hot {i}", 2020, CODES[0], round(float(rng.normal(0, 1)), 3)) for i in range(int(len(rows) * hot))]
    frame = pd.DataFrame(rows, columns=["iso3", "country", "year", "indicator", "value"])
    frame["pillar"] = [INDICATORS[c][0] for c in frame["indicator"]]
    return frame


def frame_of(df):
    return pd.DataFrame([r.asDict() for r in df.collect()])


def positions(frame):
    bounds = frame.groupby(["indicator", "year"])["value"]
    low, high = bounds.transform("min"), bounds.transform("max")
    with np.errstate(all="ignore"):
        scaled = (frame["value"] - low) / (high - low) * 100
    scaled = scaled.where([INDICATORS[c][2] > 0 for c in frame["indicator"]], 100 - scaled)
    return scaled.where(high != low, 50.0)


@pytest.mark.parametrize("seed", [1, 2])
def test_scores(spark, seed):
    frame = facts(np.random.default_rng(seed))
    got = frame_of(aggregate_esg(spark.createDataFrame(frame))).set_index(["iso3", "year"]).sort_index()
    norm = frame.assign(norm=positions(frame)).groupby(["iso3", "year", "pillar"])["norm"].mean().unstack()
    overall = norm[["environmental", "social", "governance"]].mean(axis=1)
    for pillar in norm.columns:
        np.testing.assert_allclose(got[f"{pillar}_score"].astype(float), norm[pillar], atol=0.0500001)
    np.testing.assert_allclose(got["esg_score"], overall, atol=0.0500001)
    np.testing.assert_allclose(got["esg_risk_score"], 100 - overall, atol=0.0500001)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_group_is_split_where_bounds_are_not_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    frame = facts(np.random.default_rng(3), entities=60, hot=3.0)
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        scored = normalise(spark.createDataFrame(frame).repartition(8))
        assert "skew=true" in final_plan(scored)
        got = frame_of(scored).sort_values(["iso3", "year", "indicator"])["norm"]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    expected = frame.assign(norm=positions(frame)).sort_values(["iso3", "year", "indicator"])["norm"]
    np.testing.assert_allclose(got, expected, rtol=1e-12)


def test_roll_ups(spark):
    rng = np.random.default_rng(4)
    loans = pd.DataFrame({
        "country": rng.choice(["A", "B", "C"], 400, p=[0.7, 0.2, 0.1]), "fiscal_year": rng.integers(2018, 2022, 400),
        "commitment_amount": rng.uniform(0, 1e6, 400), "disbursement_amount": rng.uniform(0, 1e6, 400)})
    got = frame_of(aggregate_loans(spark.createDataFrame(loans))).set_index(["country", "fiscal_year"]).sort_index()
    groups = loans.groupby(["country", "fiscal_year"])
    np.testing.assert_allclose(got["lending_amount"], groups["commitment_amount"].sum())
    np.testing.assert_allclose(got["disbursement_amount"], groups["disbursement_amount"].sum())
    assert got["n_loans"].tolist() == groups.size().tolist()

    ratings = loans.rename(columns={"fiscal_year": "closing_year"}).assign(is_successful=rng.integers(0, 2, 400))
    got = frame_of(aggregate_ratings(spark.createDataFrame(ratings))).set_index(["country", "year"]).sort_index()
    rate = ratings.groupby(["country", "closing_year"])["is_successful"].mean() * 100
    assert got["success_rate"].tolist() == rate.round(1).tolist()


def test_trends_and_summary(spark):
    rng = np.random.default_rng(5)
    rows = [(f"C{c}", f"Country {c}", y) for c in range(25) for y in range(2015, 2024) if rng.random() < 0.6]
    frame = pd.DataFrame(rows, columns=["iso3", "country", "year"])
    columns = ["environmental_score", "social_score", "governance_score", "esg_score", "esg_risk_score", "risk_trend",
               "lending_gap", "priority_score", "lending_amount", "success_rate"]
    for column in columns:
        values = rng.uniform(0, 100, len(frame)).round(1)
        frame[column] = np.where(rng.random(len(frame)) < 0.3, np.nan, values)
    records = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(
        [tuple(int(v) if i == 2 else v for i, v in enumerate(r)) for r in records],
        "iso3 string, country string, year int, " + ", ".join(f"{c} double" for c in columns))

    slopes = dict(risk_trends(df).collect())
    for country, group in frame.groupby("country"):
        points = group.dropna(subset=["esg_risk_score"])
        if len(points) < 3:
            assert slopes[country] is None
        else:
            assert slopes[country] == pytest.approx(np.polyfit(points["year"], points["esg_risk_score"], 1)[0], abs=0.00051)

    got = frame_of(country_summary(df)).set_index("country").sort_index()
    expected = frame.sort_values("year").groupby("country").last()
    for column in columns[:8]:
        np.testing.assert_array_equal(got[column].astype(float), expected[column])
    assert got["latest_year"].tolist() == expected["year"].tolist()
    np.testing.assert_allclose(got["total_lending_usd"], frame.groupby("country")["lending_amount"].sum())
    rate = frame.groupby("country")["success_rate"].mean()
    np.testing.assert_allclose(got["avg_success_rate"].astype(float), rate, atol=0.0500001)


def test_one_row_per_hot_key(spark):
    rng = np.random.default_rng(6)
    frame = pd.DataFrame({"k": np.where(rng.random(600) < 0.4, 0, rng.integers(1, 200, 600)),
                          "v": rng.integers(0, 1000, 600), "w": rng.integers(0, 1000, 600)})
    got = frame_of(one_per_key(spark.createDataFrame(frame).repartition(8), ["k"], ["w"])).sort_values("k")
    expected = frame.sort_values(["k", "w", "v"]).groupby("k").tail(1).sort_values("k")
    assert got[["k", "v", "w"]].to_numpy().tolist() == expected[["k", "v", "w"]].to_numpy().tolist()


def test_results_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(facts(np.random.default_rng(7)))
    one, many = (sorted(map(tuple, aggregate_esg(df.repartition(n, F.rand(n))).collect()), key=str) for n in (1, 13))
    assert one == many
