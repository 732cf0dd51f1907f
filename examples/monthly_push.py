"""End-to-end use of the library: the monthly extract -> push flow.

usage: python examples/monthly_push.py [sf_dir] [out_dir]

1. raw data values (here: the fixture view over the orders table) are
   normalised and written into the partitioned extract table;
2. a month's extracts (plus its year's) are merged;
3. identifiers are remapped through the configured dimensions;
4. data points are classified and cut into payload batches, which are written
   for the platform to send;
5. the org unit pyramid is aligned with the target's;
6. import reports coming back are summarised.
"""

from __future__ import annotations

import os
import sys
import tempfile

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aggrex import build_session, fixtures  # noqa: E402
from aggrex.operators.align import (create_payloads, ordered_for_sending, org_units_to_create,  # noqa: E402
                                    org_units_to_update, update_payloads)
from aggrex.operators.mapping import uid_mapper  # noqa: E402
from aggrex.operators.normalise import merge_extracts, normalise_data_values  # noqa: E402
from aggrex.operators.push import class_counts, classify_data_points, payload_batches  # noqa: E402
from aggrex.operators.reports import import_summary  # noqa: E402
from aggrex.sources import config as cfg  # noqa: E402
from aggrex.sources import io  # noqa: E402

CONFIG = """{
  "PUSH_SETTINGS": {"MAX_POST": 500},
  "DATA_ELEMENT_MAPPINGS": {
    "UIDS": {"DE1": "NDE1"},
    "CAT_OPTION_COMBOS": {"DEFAULT": "COCX", "UIDS": {"COCF": "NCOCF"}},
    "ATTR_OPTION_COMBOS": {"DEFAULT": "AOC0", "UIDS": {}}
  }
}"""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    out = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="aggrex-example-")
    spark = build_session("local[4]", 4)
    fixtures.register(spark, sf_dir)

    # 1. extract
    raw = spark.table("fx_data_values")
    written = io.write_extract(normalise_data_values(raw), f"{out}/extracts", extract_id="ds",
                               extract_period=F.col("period"))
    months = written.select(F.col("extract_period").alias("month")).distinct()

    # 2. merge every month with its year
    merged = merge_extracts(io.read_extract_table(spark, f"{out}/extracts"), months)

    # 3. remap through the configuration
    config = cfg.load_configuration(CONFIG)
    dims = cfg.config_dimensions(spark, config)
    settings = cfg.validate_push_settings(dims["settings"])
    mapped = uid_mapper(dims["uid_mapping"], dims["uid_defaults"])(merged)

    # 4. classify, batch, write payloads
    classified = classify_data_points(mapped)
    class_counts(classified, by=["merge_month"]).orderBy("merge_month", "class").show(6)
    batches = payload_batches(classified, max_post=settings["MAX_POST"],
                              group_cols=["merge_month"])
    io.write_payloads(batches, f"{out}/payloads")
    print("payload batches:", spark.read.parquet(f"{out}/payloads").count())

    # 5. align the pyramid
    src, tgt = spark.table("fx_pyramid_source"), spark.table("fx_pyramid_target")
    org_payloads = ordered_for_sending(
        create_payloads(org_units_to_create(src, tgt)).select("action", "id", "level", "payload")
        .unionByName(update_payloads(org_units_to_update(src, tgt, order_col="k"))))
    org_payloads.write.mode("overwrite").json(f"{out}/org_units")
    print("org unit requests:", org_payloads.count())

    # 6. summarise import reports
    import_summary(spark.table("fx_import_reports"), by=["phase"]).show()
    spark.stop()


if __name__ == "__main__":
    main()
