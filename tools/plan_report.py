"""Write PLANS.md: the physical-plan shape of the main models at scale.

Broadcast thresholds are switched off so the plans show what a cluster
reading large inputs gets (AQE would broadcast small sides at runtime).
For each model: exchanges, joins, partial window-group limits, and the
parquet scans' pushed filters / read schema.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finspark.plans.pipeline import Pipeline  # noqa: E402
from finspark.session import get_spark  # noqa: E402

MODELS = ["silver_transactions", "silver_payments", "gold_transaction_facts", "gold_daily_revenue",
          "gold_monthly_revenue", "gold_mrr", "gold_customer_metrics", "gold_cohort_retention",
          "platinum_finance_exec_scorecard_daily", "platinum_anomalies_daily"]


def shape(txt: str) -> list[str]:
    out = []
    for pat, label in ((r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", "Exchange"),
                       (r"(SortMergeJoin|BroadcastHashJoin|BroadcastNestedLoopJoin|ShuffledHashJoin)", "Join"),
                       (r"WindowGroupLimit \[[^\]]*\].*?(Partial|Final)", "WindowGroupLimit")):
        for m, n in Counter(re.sub(r"#\d+L?", "", x) for x in re.findall(pat, txt)).items():
            out.append(f"{label} {m} ×{n}")
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    p = Pipeline(spark, sf)
    print("# Physical plans of the main models (broadcast thresholds off)\n")
    print("Generated by `python tools/plan_report.py`. Exchanges are shuffles; a `Partial` WindowGroupLimit")
    print("runs before its shuffle (map-side top-1 per key).\n")
    for m in MODELS:
        txt = p.ref(m)._jdf.queryExecution().executedPlan().toString()
        print(f"## {m}\n")
        for line in shape(txt):
            print(f"- {line}")
        for scan in re.findall(r"FileScan parquet [^\n]*", txt):
            table = re.search(r"/([a-z]+)\.parquet", scan)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", scan)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", scan)
            print(f"- Scan `{table.group(1) if table else '?'}` pushed {pushed.group(1) if pushed else '[]'}, "
                  f"reads `{schema.group(1) if schema else '?'}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
