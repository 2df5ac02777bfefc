"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs once untimed, to warm the JVM, and is then timed end to end: building the frames, writing
intermediate tables and consuming every output row.
"""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from registry.queries import REGISTRY  # noqa: E402
from vendaflow.session import build_session  # noqa: E402

HEADLINE = [
    "silver_clientes", "silver_pedidos", "silver_itens", "fact_sales", "dim_cliente", "mart_vendedor",
    "abc_curve", "mart_financeiro", "order_gaps", "feature_table", "training_table", "univariate_auc",
    "score_bands", "calibration_table", "suggest_products", "customer_context", "weekly_queue",
    "kpi_monthly", "sales_by_dimensions", "top20_customers", "sales_by_region_month", "quality_suite",
    "feature_history", "active_customers_by_day", "order_value_sketches", "best_stock_suggestion",
]


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        consume(REGISTRY[name].run(spark, sf_dir))
        start = time.perf_counter()
        consume(REGISTRY[name].run(spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
