"""Print the physical plan of registered queries, or of the load's classification join.

usage: python tools/explain.py [sf_dir] name [name ...]
       python tools/explain.py [sf_dir] load-classify     (bucketed satellite from a first load)
"""

from __future__ import annotations

import datetime as dt
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from vaultkit.session import build_session
    from vaultkit.plans.registry import QUERIES
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session()
    for name in args:
        print(f"\n===== {name} =====")
        if name == "load-classify":
            from vaultkit.operators import delta as D
            from vaultkit.plans.load import run_delta_load
            from vaultkit.plans.store import scratch_store
            from vaultkit.sources import schemas as SC, testbed as tb
            from vaultkit.sources.tables import Tables
            from vaultkit.spec import PRODUCT, LoadContext
            t = Tables(spark, sf_dir)
            store = scratch_store(spark, "explain")
            ctx = LoadContext(batch_id="X1", run_ts=dt.datetime(2025, 1, 1), record_source="CRM",
                              source_object=tb.STAGING_MODEL, use_watermark=False)
            run_delta_load(store, tb.stage(tb.day1_rows(t), PRODUCT, tb.DAY1_BATCH, tb.DAY1_TS), PRODUCT, ctx,
                           satellite_buckets=8)
            dq = D.dq_passed(tb.staging_day2(t), store.read("reject", SC.REJECT), None, PRODUCT, ctx)
            D.classify(dq, store.read("sat_product", SC.satellite(PRODUCT))).explain("formatted")
        else:
            QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
