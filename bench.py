"""Benchmark: the pipeline and headline report queries at one scale factor.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
Each query is forced to run completely with a ``noop`` write (no collect).
Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobstar.plans import reports as R  # noqa: E402
from jobstar.plans.pipeline import Star  # noqa: E402
from jobstar.operators import quality, skills  # noqa: E402
from jobstar.operators.upsert import upsert_by_job  # noqa: E402
from jobstar.session import build_session, materialize  # noqa: E402
from jobstar.sources.standin import feed_rows  # noqa: E402
from jobstar.sources.tables import Tables  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # Local runs: shuffle partitions = 2 x cores, kept as is. AQE's coalescing would
    # merge these small-in-bytes but CPU-heavy stages (JSON, regex) onto fewer tasks;
    # on a cluster, partitions are sized by bytes instead and coalescing stays on.
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.range(1).count()  # JVM warm-up outside the timings

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # The stand-in feed, written once (the copy every later step reads). Making it is no
    # operator of the library, so its time stands apart from the total.
    landed = timed("land_feed", lambda: materialize(feed_rows(Tables(spark, sf_dir)), "landed"))
    setup = {"land_feed": times.pop("land_feed")}
    s = Star(spark, raw=upsert_by_job(None, landed, cpus * 2))
    # Pipeline layers: upsert + staging (written once), then keys, fact and bridge on it.
    timed("stage_jobs", lambda: s.stg)
    timed("star_build", lambda: (s.dim_company, s.dim_location, s.dim_category, s.fact, run(s.fact)))
    timed("bridge", lambda: run(s.bridge))
    # Headline questions over the built star.
    timed("top_skills", lambda: run(skills.top_skills(s.bridge, s.dim_skill, s.fact)))
    timed("dq_report", lambda: run(quality.dq_report(s.stg, "2001-06-01")))
    timed("fuzzy_dup_tight", lambda: run(quality.fuzzy_dup_tight(s.stg)))
    timed("salary_stats", lambda: run(R.salary_stats(s)))
    timed("location_drilldown", lambda: run(R.location_drilldown(s)))
    timed("postings_by_city", lambda: run(R.postings_by_location(s, "city", 10)))
    timed("monthly_profile", lambda: run(R.monthly_profile(s)))

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "pipeline_plus_reports_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "setup": setup,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
