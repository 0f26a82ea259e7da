"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs
per query (the median counts) after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from goldenrec.plans.queries import QUERIES, RUN_TS, lake
from goldenrec.plans.pipeline import build_lake
from goldenrec.session import build_session, checkpoint_dir
from goldenrec.sources.registries import derive_all

# Straight from the tables, layers included.
COMPUTED = (
    "norm_e164",
    "doc_check_digits",
    "latest_per_key",
    "latest_per_composite_key",
    "std_a_clientes",
    "std_d_fornecedores",
    "cluster_clientes",
    "golden_clientes",
    "golden_fornecedores",
    "metricas_qualidade",
    "volume_anomaly",
)
# On the stored lake, as a reader of gold would.
STORED = (
    "page_deep",
    "search_name",
    "search_city",
    "search_doc",
    "detail",
    "sql_unique",
    "sql_by_uf",
    "lineage",
    "source_lookup",
    "dq_unique",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(work, times: int = runs) -> float:
        seconds = []
        for _ in range(times + 1):
            started = time.perf_counter()
            work()
            seconds.append(time.perf_counter() - started)
        return round(statistics.median(seconds[1:]), 3)

    def forced(name: str):
        return lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    times = {name: timed(forced(name)) for name in COMPUTED}
    lake(spark, folder)
    times.update({name: timed(forced(name)) for name in STORED})
    base = f"{checkpoint_dir(spark)}/bench-lake"
    times["pipeline"] = timed(
        lambda: build_lake(derive_all(spark, folder), base, RUN_TS).checks.collect(), 1
    )
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )


if __name__ == "__main__":
    main()
