"""Time the headline queries: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

The small test tables are files of one row group, which no setting can split:
a scan would be one task however many cores there are. Before the clock
starts, the two large tables are laid out as one file per core, as tables on
a cluster are; the queries and their plans are the same. The time that takes
is reported as ``layout_sec``; BENCH_AS_IS=1 leaves the tables as they are.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = ("top_customers", "monthly_trend", "city_analysis", "seller_ranking", "product_analysis",
            "channel_analysis", "product_yoy", "sales_view", "base_measures", "mom", "ytd", "dense_ranks",
            "quality_log", "column_profile", "clean_rows", "scd2_history", "asof_customer", "fact_resolved",
            "orphans", "erased_customers", "fact_insert_new", "portability_report")
LARGE_TABLES = ("lineitem", "orders")


def laid_out(spark, sf_dir: str, files: int) -> str:
    """A folder with the tables of ``sf_dir``, the large ones in ``files`` files each."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for table in Path(sf_dir).glob("*.parquet"):
        if table.stem in LARGE_TABLES:
            spark.read.parquet(str(table)).repartition(files).write.parquet(f"{folder}/{table.name}")
        else:
            os.symlink(table, f"{folder}/{table.name}")
    return folder


def main() -> None:
    from checks.queries import QUERIES
    from salesmart.session import build_session
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    started = time.time()
    tables = sf_dir if os.environ.get("BENCH_AS_IS") else laid_out(spark, sf_dir, cpus)
    spark.read.parquet(f"{tables}/nation.parquet").count()
    layout = round(time.time() - started, 3)
    times = {}
    for name in names:
        started = time.time()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "layout_sec": layout, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
