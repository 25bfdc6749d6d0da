"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query is planned
and run once in full (all rows and columns are computed, none is kept), after one
unmeasured run of the same queries on the smallest tables to load the engine.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wardline.plans.queries import QUERIES  # noqa: E402
from wardline.session import local_session  # noqa: E402

HEADLINE = [
    "gov_2_merged_spans", "gov_11_classification", "gov_16_decisions", "gov_17_sanitized_prompts",
    "gov_18_vault_table", "gov_20_audit_records", "gov_21_spend",
    "idn_2_minted_tokens", "idn_5_verified_chains",
    "red_1_injections", "red_5_verdicts",
    "con_3_send_decisions", "con_5_campaign_totals",
    "tri_6_risk_order", "tri_7_deduped", "tri_8_top_queue", "tri_9_totals",
    "pen_4_summary", "pen_5_worklist", "rel_5_gate", "rel_5_gate_lists",
    "aut_6_audit_records", "rsp_2_plans", "cfg_1_compliance",
    "scn_3_scan", "scn_4_file_summaries", "web_4_findings",
    "reg_1_threat_coverage", "inc_1_timelines", "inc_2_records",
    "str_2_response_stream", "str_3_first_seen_stream",
]


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    cores = int(cpus) if cpus.isdigit() else 8
    # every table is one file with one row group here, so it is dealt out on request
    with tempfile.TemporaryDirectory(prefix="wardline-bench-") as shared:
        measure(local_session(cpus, shuffle_partitions=cores, shared=shared, pieces=cores), folder)


def measure(spark, folder: str) -> None:
    smallest = "/root/testdata/sf0.001"
    if Path(smallest).exists() and not os.environ.get("BENCH_NO_WARM"):
        for name in HEADLINE:
            run(spark, name, smallest)
    seconds = {name: round(run(spark, name, folder), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
