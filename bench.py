"""Run the headline queries once each and print one JSON line of seconds."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ensemblage.plans import catalog  # noqa: E402
from ensemblage.session import local_session  # noqa: E402

HEADLINE = (
    "thm_table", "thm_from_logs", "nmr_tables", "prj_reject_reason", "scr_cluster_representatives", "join_pair_candidates",
    "log_shielding_rows", "log_coupling_rows", "src_multixyz", "eqv_group_couplings", "agg_progress", "str_progress",
    "dq_screen_contract", "lin_upstream_chain", "scr_moi_descriptor", "scr_cluster_threshold",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    catalog.load()
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder)}))


if __name__ == "__main__":
    main()
