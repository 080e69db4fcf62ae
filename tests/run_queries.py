"""Run registered queries against their SQL twins: ``run_queries.py DIR [NAME ...]``."""

import sys
import time

from oracle import difference

from tarnwater.plans import REGISTRY
from tarnwater.session import build_session


def main() -> None:
    path, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", "spark.log.level": "ERROR"}
    )
    for name in names:
        query, start = REGISTRY[name], time.time()
        try:
            df = query(spark, path)
            result = difference(df, path, query.sql) if query.sql else f"rows only: {[tuple(r) for r in df.collect()][:12]}"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {result or 'equal'}", flush=True)


main()
