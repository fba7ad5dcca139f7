"""Headline timings on the derived change log; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each entry is one cold run in a fresh warehouse on local[$BENCH_CPUS].  The
change log is exported as capture files and landed first; the exports are setup
and not timed, landing is.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.catalog.context import EXPORT, Context
from tidemark.catalog.queries import QUERIES
from tidemark.operators import checks, compare, history
from tidemark.plans import build, layers, update
from tidemark.session import local_session
from tidemark.streaming.batches import BatchGate

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = os.environ.get("BENCH_CPUS", "8")
# The derived log holds references to deleted orders and customers on purpose.
EXPECTED = ("relationships",)
OPERATORS = (
    "delivery_profile",
    "reconcile",
    "marts_survive_redelivery",
    "lifecycle_report",
    "mart_checks",
    "orders_with_customer",
)


def main() -> None:
    spark = local_session(CORES, int(CORES) * 2, "tidemark-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action):
        begun = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
        return result

    def drain(frame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    context = Context(spark, FOLDER)
    captures = context.captures  # setup: exported capture files
    store = context.new_warehouse()
    gate = BatchGate(store, captures)

    timed("batch_check", lambda: gate.prepare("bench"))
    metrics = timed("land_captures", lambda: store.land_pending(captures, EXPORT))
    events = sum(v for k, v in metrics.items() if k.startswith(("input_", "snapshot")))
    timed("build_marts_and_checks", lambda: build.build(store, allow=EXPECTED))
    gate.complete("bench")
    timed("idle_check", lambda: gate.prepare("idle"))
    timed("rebuild_marts_and_checks", lambda: build.build(store, allow=EXPECTED))
    late = spark._jvm.org.apache.hadoop.fs.Path(captures.rstrip("/") + "/cdc/late.csv")
    text = "".join(f"U,customers,ecommerce,{n},P{n},00000001,moved,N1,2024-06-01 00:00:00,{10**9 + n},2024-06-01 00:00:00\n" for n in range(1, 16))
    out = late.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(late)
    out.write(bytearray(text.encode()))  # setup: 15 late events
    out.close()
    before = {r["load_id"] for r in store.loads().collect()}
    timed("land_small_batch", lambda: store.land_pending(captures, EXPORT))
    loads = [r["load_id"] for r in store.loads().collect() if r["load_id"] not in before]
    timed("update_for_small_batch", lambda: update.update(store, loads, allow=EXPECTED))

    raw = store.raw_tables()
    marts = layers.marts_from_raw(raw)
    for name, frame in marts.items():
        timed(name, lambda f=frame: drain(f))
    for table, frame in raw.items():
        timed(f"stage_{table}", lambda f=frame, t=table: drain(layers.stage(f, t)))
    timed("raw_checks", lambda: checks.raw_checks(raw).collect())
    timed("conflicting_copies", lambda: drain(checks.conflicting_copies(raw)))
    timed(
        "dim_customer_history_sliced",
        lambda: drain(
            history.customer_history(
                raw["customers"], history.Slicing.of(raw["customers"], "customer_id", heavy_rows=500, slice_rows=200)
            )
        ),
    )
    timed("fingerprint_fct_orders", lambda: compare.fingerprint(marts["fct_orders"]).collect())

    for warm in (context.stored_marts, context.stored_staged, context.stored_live):
        assert dict(warm)  # setup: written inputs of the operator queries
    for name in OPERATORS:
        timed(name, lambda n=name: drain(QUERIES[n](spark, FOLDER)))

    print(
        json.dumps(
            {
                "metric": "change log to marts and checks",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "raw_events": events,
                "cores": int(CORES),
            }
        )
    )


if __name__ == "__main__":
    main()
