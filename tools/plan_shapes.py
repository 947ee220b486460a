"""Print, per query, how many shuffles, broadcasts, scans, windows and Python steps its plan has."""

import re
import sys

sys.path.insert(0, ".")
from ensemblage.plans import catalog  # noqa: E402
from ensemblage.session import local_session  # noqa: E402

catalog.load()
spark = local_session("8")
spark.sparkContext.setLogLevel("ERROR")
names = sys.argv[2:] or list(catalog.QUERIES)
for name in names:
    df = catalog.QUERIES[name](spark, sys.argv[1])
    df.write.format("noop").mode("overwrite").save() if "--run" in sys.argv else None
    plan = df._jdf.queryExecution().executedPlan().toString()
    count = {k: len(re.findall(p, plan)) for k, p in {
        "shuffles": r"(?<!Broadcast)Exchange (?:hash|range|Round|Single)", "broadcasts": r"BroadcastExchange", "scans": r"FileScan",
        "windows": r"\bWindow \[", "python": r"InPandas|ArrowEval|BatchEvalPython", "nested": r"BroadcastNestedLoopJoin|CartesianProduct"}.items()}
    print("PLAN", name, count, flush=True)
