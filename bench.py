"""Time the headline queries on the test tables and print one JSON line.

Each query is planned and run end to end into a sink that discards the rows. The reported time
is the median of three runs, after all queries ran once to warm up. Bytes written to shuffles and
the number of exchanges in the plans that ran are those of the last run, from Spark's event log.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from paygrain.catalog.queries import REGISTRY  # noqa: E402
from paygrain.session import build_session  # noqa: E402

HEADLINE = [
    "payment_performance_daily", "decline_analysis_monthly", "merchant_intelligence", "customer_analytics",
    "fraud_risk_segments", "transaction_velocity", "merchant_daily_anomalies", "executive_kpis_monthly",
    "fraud_model_features", "velocity_band_summary", "anomaly_summary",
]
RUNS = 3


def run_once(spark, name: str, directory: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def exchanges(node: dict) -> int:
    own = node["nodeName"] in ("Exchange", "BroadcastExchange")
    return own + sum(map(exchanges, node["children"]))


def logged(folder: str, spans: dict[str, tuple[float, float]]) -> tuple[dict[str, float], dict[str, int]]:
    """Shuffle megabytes and exchanges of what began within each span of time."""

    def of(milliseconds: float) -> str | None:
        return next((n for n, (a, b) in spans.items() if a <= milliseconds / 1000 <= b), None)

    written, begun, plans = dict.fromkeys(spans, 0), {}, {}
    for path in Path(folder).rglob("*"):
        for line in path.open() if path.is_file() and not path.name.endswith(".crc") else ():
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd" and (name := of(event["Task Info"]["Launch Time"])):
                written[name] += (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            elif "sparkPlanInfo" in event:
                plans[event["executionId"]] = event["sparkPlanInfo"]  # the last is the one that ran
                if "time" in event:
                    begun[event["executionId"]] = of(event["time"])
    found = dict.fromkeys(spans, 0)
    for key, plan in plans.items():
        if begun.get(key):
            found[begun[key]] += exchanges(plan)
    return {n: round(b / 1e6, 2) for n, b in written.items()}, found


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    events = tempfile.mkdtemp(prefix="paygrain-bench-")
    spark = build_session(
        "paygrain-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{events}", "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in names:
        run_once(spark, name, directory)
    seconds, spans = {}, {}
    for name in names:
        runs = []
        for _ in range(RUNS):
            began = time.time()
            runs.append(run_once(spark, name, directory))
            spans[name] = (began, time.time())
        seconds[name] = round(statistics.median(runs), 3)
    spark.stop()
    shuffled, exchanged = logged(events, spans)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of median seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "shuffle_mb": shuffled,
                "exchanges": exchanged,
                "sf": Path(directory).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
