"""Print a one-line plan summary per registered query (exchanges, join kinds,
single-partition exchanges, scanned columns)."""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farebox.plans.catalog import all_queries  # noqa: E402
from farebox.session import get_spark  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    for name, fn in sorted(all_queries().items()):
        df = fn(spark, sf)
        txt = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        plan = txt.split("\n\n")[0]
        ex = plan.count("Exchange ") + plan.count("Exchange\n")
        flags = [k for k in ("SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "SortAggregate")
                 if k in plan]
        single = len(re.findall(r"Exchange SinglePartition|SinglePartition", txt))
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", txt)
        widest = max((len(s.split(",")) for s in schemas), default=0)
        print(f"{name:30s} exch={ex:2d} single={single:2d} scans={len(schemas)} widest={widest:2d} {' '.join(flags)}")


if __name__ == "__main__":
    main()
