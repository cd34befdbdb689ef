"""Run the whole batch job (M20) on the parquet tables and print its metrics.

Usage: python tools/run_job.py <sf_dir> <out_dir> [max_iter]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rekko.plans import train_eval  # noqa: E402
from rekko.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir, out_dir = sys.argv[1], sys.argv[2]
    params = {"maxIter": int(sys.argv[3])} if len(sys.argv) > 3 else None
    spark = get_spark("local[8]", shuffle_partitions=16,
                      extra_conf={"spark.driver.memory": "16g"})
    metrics = train_eval.run(spark, train_eval.inputs_from_tables(spark, sf_dir), out_dir,
                             model_params=params)
    print(json.dumps(metrics, default=float))
    spark.stop()


if __name__ == "__main__":
    main()
