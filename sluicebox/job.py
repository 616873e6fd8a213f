"""Batch job: raw tables in, data-quality and funnel reports, session mart and headline figures out."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from sluicebox.config import DEFAULT_RELATIVE_IMPROVEMENT
from sluicebox.plans.mart import fct_sessions
from sluicebox.plans.quality import report_despite_errors
from sluicebox.plans.tables import headline_report
from sluicebox.plans.validation import raw_funnel_validation
from sluicebox.session import build_session, unsized_shuffles
from sluicebox.sources.event_log import stage_event_log
from sluicebox.sources.raw import RawTables, load_raw
from sluicebox.sources.sinks import read_mart, write_mart, write_report_csv


def run(spark: SparkSession, raw: RawTables, out_dir: str, relative_improvement: float = DEFAULT_RELATIVE_IMPROVEMENT) -> DataFrame:
    """Write the reports and the mart below ``out_dir``; returns the headline figures.

    The mart is computed once, and everything after it reads the stored table: later queries on it, filtered or not,
    need no raw data, and a lost executor costs the tasks it ran, not the way from raw events to the mart.
    """
    write_report_csv(report_despite_errors(raw), f"{out_dir}/data_quality_report")
    write_report_csv(raw_funnel_validation(raw), f"{out_dir}/funnel_validation")
    write_mart(fct_sessions(raw), f"{out_dir}/fct_sessions")
    headline = headline_report(read_mart(spark, f"{out_dir}/fct_sessions"), relative_improvement)
    write_report_csv(headline, f"{out_dir}/headline_report")
    return headline


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("in_dir", help="folder with the raw tables")
    parser.add_argument("out_dir", help="folder for the mart and the reports")
    parser.add_argument("--event-log", action="store_true", help="derive the raw tables from events.parquet in in_dir")
    parser.add_argument("--relative-improvement", type=float, default=DEFAULT_RELATIVE_IMPROVEMENT)
    options = parser.parse_args(arguments)
    spark = build_session("sluicebox job")
    if options.event_log:
        raw = stage_event_log(spark, options.in_dir, f"{options.out_dir}/raw")
    else:
        raw = load_raw(spark, options.in_dir)
    run(spark, raw, options.out_dir, options.relative_improvement).show(truncate=False)
    unsized_shuffles(spark)


if __name__ == "__main__":
    main()
