"""Write orders by status, as the layout queries do, with an event log in the
folder given, and print OK if no writing task held rows to sort them. Used by
tests/test_layout_reuse.py."""

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import layout  # noqa: E402
from strata.plans import queries  # noqa: E402
from strata.session import local_session, release_scratch  # noqa: E402
from strata.sources.tables import SCHEMAS  # noqa: E402


def main(folder, rows=30_000):
    spark = local_session("4", shuffle_partitions=6, app_name="strata-layout", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": folder, "spark.eventLog.compress": "false"})
    status = F.element_at(F.array(*map(F.lit, ("F", "O", "P", None))), (F.floor(F.col("id") / 2) % 4 + 1).cast("int"))
    values = {"o_orderkey": F.col("id"), "o_orderstatus": status}
    orders = spark.range(rows).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS["orders"]])
    orders.write.parquet(f"{folder}/orders.parquet")
    got = {r["o_orderstatus"]: (r["rows"], r["files"]) for r in queries.q_file_layout_report(spark, folder).collect()}
    assert got == {s: (rows // 4, 1) for s in ("F", "O", "P", "__HIVE_DEFAULT_PARTITION__")}, got
    path, _ = queries._fragmented(spark, folder)
    assert layout.compact_folder(spark, path).count() > 4
    assert spark.read.parquet(path).count() == rows
    release_scratch(spark)
    spark.stop()
    log = [json.loads(line) for f in glob.glob(f"{folder}/*/events_*") + glob.glob(f"{folder}/local-*") if os.path.isfile(f) for line in open(f)]
    wrote = [m for e in log if e["Event"] == "SparkListenerTaskEnd" and (m := e["Task Metrics"])["Output Metrics"]["Records Written"]]
    wrote = [m for m in wrote if m["Output Metrics"]["Records Written"] > 100]       # not the lists of files
    assert sum(m["Output Metrics"]["Records Written"] for m in wrote) == 4 * rows
    assert max(m["Peak Execution Memory"] for m in wrote) == 0, [m["Peak Execution Memory"] for m in wrote]
    print("OK")


if __name__ == "__main__":
    main(sys.argv[1])
