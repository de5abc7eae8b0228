"""Run registered queries of access_spark.llm on a folder: python tests/llm/run_queries.py FOLDER NAME..."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from check import compare, duck  # noqa: E402

from access_spark.llm.queries import ORACLES, QUERIES  # noqa: E402
from access_spark.session import local_session  # noqa: E402

if __name__ == "__main__":
    spark = local_session(os.environ.get("CORES", "2"), "llm")
    folder = sys.argv[1]
    for name in sys.argv[2:]:
        start = time.time()
        df = QUERIES[name](spark, folder)
        if name in ORACLES:
            print(name, compare(df, duck(folder), ORACLES[name]), round(time.time() - start, 1))
        else:
            df.write.mode("overwrite").parquet(f"/tmp/try/{name}")
            print(name, spark.read.parquet(f"/tmp/try/{name}").count(), round(time.time() - start, 1))
            spark.read.parquet(f"/tmp/try/{name}").show(8)
