"""Batch job: build every layer and the reports.

    spark-submit --py-files finspark.zip finspark/plans/run.py --sf-dir <tables> --out <shared folder>

Silver is written first and read back, so gold and platinum are planned on
top of the written silver tables (lineage cut at the layer boundary, the
same files serve every downstream model).  Gold and platinum follow, each measured as it is written,
then the validation / insight / compliance reports as JSON; validation reads the measurements.  Every output is a
full-refresh write of its own folder.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from finspark.config import PipelineConfig
from finspark.plans.catalog import LAYER_MODELS
from finspark.plans.metrics import use_metrics, write_measured
from finspark.plans.pipeline import Pipeline


def build_all(spark: SparkSession, sf_dir: str, out: str, config: PipelineConfig | None = None,
              layers=("silver", "gold", "platinum")) -> dict[str, str]:
    from finspark.operators.compliance import pii_column_findings, pii_value_findings
    from finspark.operators.ingest import gather, validation_report
    from finspark.operators.insight import finance_insight
    from finspark.sources.files import write_report

    p = Pipeline(spark, sf_dir, config)
    written: dict[str, str] = {}
    metrics = f"{out.rstrip('/')}/metrics"
    for layer in layers:
        for m in LAYER_MODELS[layer]:
            path = f"{out.rstrip('/')}/{layer}/{m}"
            write_measured(p, m, path, metrics)
            written[m] = path
    use_metrics(p, metrics)
    reports = {
        "validation_report": validation_report(p),
        "daily_finance_insights": finance_insight(p),
        "compliance_findings": gather({"columns": pii_column_findings(spark, p),
                                       "values": pii_value_findings(spark, p)}),
    }
    for name, df in reports.items():
        written[name] = write_report(df, f"{out.rstrip('/')}/reports/{name}")
    return written


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", type=dt.date.fromisoformat, help="run date, YYYY-MM-DD (default: the current date)")
    args = ap.parse_args()
    from finspark.session import get_spark, size_shuffle_partitions
    from finspark.sources.tables import DRIVER_TABLES, table_path
    spark = get_spark()
    size_shuffle_partitions(spark, [table_path(args.sf_dir, t) for t in DRIVER_TABLES])
    for name, path in build_all(spark, args.sf_dir, args.out, PipelineConfig(as_of=args.as_of)).items():
        print(name, path)


if __name__ == "__main__":
    main()
