"""Executed physical plans of every registered event query, as at scale.

Each query runs once with broadcast joins disabled (at 100 TB nothing large
fits a broadcast); the counts are of the final adaptive plan: shuffles, those
read again (ReusedExchange), joins, windows, generators, scans of files.
Prints a markdown table.
Usage: python scripts/plan_report.py [sf_dir]
"""
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from rillet.plans.catalog import QUERIES
from rillet.session import build_session

spark = build_session(master="local[8]", shuffle_partitions=16, extra={"spark.checkpoint.dir": tempfile.mkdtemp()})
spark.sparkContext.setLogLevel("ERROR")
spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
print("| query | exchanges | reused | joins | windows | generators | expands | scans | pushed equality | read columns |")
print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
for name in sorted(QUERIES):
    df = QUERIES[name](spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # runs it, so the adaptive plan is final
    final = qe.executedPlan().toString().split("== Initial Plan ==")[0].split("\n")

    def count(pattern: str) -> int:
        return sum(1 for line in final if re.search(r"[-*)] *" + pattern, line))

    scans = [line for line in final if "FileScan" in line]
    columns = sorted({c.split(":")[0] for line in scans for m in re.findall(r"ReadSchema: struct<([^>]*)>", line)
                      for c in m.split(",")})
    pushed = any(re.search(r"PushedFilters: \[[^\]]*EqualTo", line) for line in scans)
    print(f"| {name} | {count('Exchange ')} | {count('ReusedExchange ')} | {count(r'[A-Za-z]+Join ')} | "
          f"{count(r'Window ')} | {count('Generate ')} | {count('Expand ')} | {len(scans)} | "
          f"{'yes' if pushed else ''} | {'; '.join(columns)} |")
