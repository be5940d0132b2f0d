"""The live tables as a job (survey M1-M3, L3).

    python -m harborline.streaming.live_run BRONZE STATE [--once]

``BRONZE`` holds Parquet folders ``raw_shipments``, ``raw_vessel_calls`` and
``ph_ports``.  Both streams run with their target lag as trigger, 5 and 15 minutes, and
log every refresh under ``STATE/refresh_log``; ``--once`` drains what is there and
prints the lag report.  Started again, they go on from their checkpoints.
"""

from __future__ import annotations

import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession

from ..plans import dims
from ..plans.warehouse import SEED_MAX_ROWS
from ..operators.broadcast import checked_broadcast
from . import live as sl
from . import refresh_log as rl


def start(spark: SparkSession, bronze: str, state: str, once: bool = False) -> tuple[list, DataFrame | None]:
    """Start both streams; with ``once``, drain them and return their lag report too."""
    ports = checked_broadcast(dims.dim_port(spark.read.parquet(f"{bronze}/ph_ports")), SEED_MAX_ROWS)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    listener = rl.RefreshLog(spark, f"{state}/refresh_log")
    spark.streams.addListener(listener)

    def trigger(name: str) -> dict:
        return {"availableNow": True} if once else {"processingTime": f"{sl.TARGET_LAG[name]:.0f} minutes"}
    started = []
    for name, table, run in (
            ("dt_active_shipments", "raw_shipments", lambda *a, **k: sl.stream_active_shipments(*a, ports, now, **k)),
            ("dt_port_congestion", "raw_vessel_calls", lambda *a, **k: sl.stream_port_congestion(*a, ports, **k))):
        started.append(run(spark, f"{bronze}/{table}", f"{state}/{name}", f"{state}/checkpoints/{name}",
                           trigger=trigger(name))[0])
    if not once:
        return started, None
    for q in started:
        listener.wait(q)
    spark.streams.removeListener(listener)
    return started, rl.refresh_lag(rl.read_log(spark, f"{state}/refresh_log"), sl.TARGET_LAG,
                                   dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


def main(argv: list[str]) -> int:
    from ..session import build_session
    if len(argv) < 2:
        print(__doc__)
        return 2
    spark = build_session(app="harborline-live")
    _, lag = start(spark, argv[0].rstrip("/"), argv[1].rstrip("/"), once="--once" in argv)
    if lag is None:
        spark.streams.awaitAnyTermination()
        return 1                # a live stream ends only by an error
    rows = lag.collect()        # one per live table
    for r in rows:
        print(r.asDict())
    return int(any(r.lag_status != "OK" for r in rows))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
