"""Analysis job: everything that is derived from the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.correlation import pillars_by_risk_bin, risk_success_correlation, success_by_risk_bin
from riskloom.operators.coverage import coverage_report, years_covered
from riskloom.operators.exposure import add_exposure, add_lending_gap, add_priority, add_risk_trend
from riskloom.operators.master import top_borrowers
from riskloom.operators.panels import (
    dashboard_panels,
    lending_chart,
    pillar_chart,
    success_chart,
    top_gap,
    top_priority,
)
from riskloom.operators.summary import country_summary
from riskloom.session import releasing, stored
from riskloom.sinks.tables import write_csv
from riskloom.sources.files import read_table_file
from riskloom.vocabulary import ANALYSIS_COLUMNS, MASTER


def enrich(master: DataFrame) -> DataFrame:
    """Master table with exposure, priority, trend and lending gap."""
    return add_lending_gap(add_risk_trend(add_priority(add_exposure(master))))


def analysis_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in ANALYSIS_COLUMNS if c in df.columns])


def analyse(master: DataFrame, year: int | None = None) -> dict[str, DataFrame]:
    """All analysis outputs. The enriched table is stored once, because every output reads it."""
    rows = stored(enrich(master), "enriched")
    outputs = {
        "coverage": coverage_report(rows),
        "years": years_covered(rows),
        "correlation": risk_success_correlation(rows),
        "success_by_bin": success_by_risk_bin(rows),
        "pillars_by_bin": pillars_by_risk_bin(rows),
        "top_gap": top_gap(rows),
        "top_priority": top_priority(rows, year),
        "top_borrowers": top_borrowers(rows),
        "country_summary": country_summary(rows),
        "analysis": analysis_columns(rows),
        "chart_pillars": pillar_chart(rows),
        "chart_lending": lending_chart(rows),
        "chart_success": success_chart(rows),
    }
    outputs |= {f"panel_{name}": df for name, df in dashboard_panels(rows, year).items()}
    return outputs


def run_analysis_files(spark: SparkSession, master: str, out: str, year: int | None = None) -> dict[str, int]:
    """Read the master CSV and write the analysis and summary tables as CSV."""
    with releasing(spark):
        outputs = analyse(read_table_file(spark, master, MASTER), year)
        return {name: write_csv(outputs[name], f"{out}/{name}.csv") for name in ("analysis", "country_summary")}
