"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores.
Each query writes to the ``noop`` sink, so all columns of all rows are computed and
nothing is collected. Inputs that a query reads as tables are written beforehand.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plumelake.operators import alerts as al, model as ml, reports as rp  # noqa: E402
from plumelake.operators.features import features  # noqa: E402
from plumelake.plans import queries as q  # noqa: E402
from plumelake.session import build_session, written  # noqa: E402
from plumelake.sources import readers  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        # The sample is small: keep its few megabytes on all cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
    })
    spark.sparkContext.setLogLevel("ERROR")

    few = readers.read_clean(spark, q._clean_files(spark, sf_dir))
    many = written(q._clean(spark, sf_dir, "user_id"), "clean-users")
    feats = written(features(few, scale=2), "features")
    frame = ml.training_frame(feats)
    scored = ml.score_with(frame, q.WEIGHTS, q.MEANS, q.STDS, q.BIAS, q.RUN_TS)
    model = ml.fit(ml.split(frame, method="hash")[0])

    timed = {
        "curate": lambda: q.curated_readings(spark, sf_dir),
        "features_bucket_5_stations": lambda: features(few),
        "features_range_5_stations": lambda: features(few, method="range"),
        "features_bucket_many_stations": lambda: features(many),
        "features_range_many_stations": lambda: features(many, method="range"),
        "raw_to_features": lambda: q.feature_table(spark, sf_dir),
        "fit": lambda: spark.createDataFrame(
            [ml.model_coefficients(ml.fit(ml.split(frame, method="hash")[0]))["bias"]], "double"),
        "score_model": lambda: ml.score(model, frame, q.RUN_TS),
        "score_expression": lambda: scored,
        "metrics": lambda: ml.metrics(scored),
        "auc": lambda: ml.auc(scored),
        "alert_digest": lambda: al.digest(al.alerts(scored, q.NOW), q.NOW, "station_id", part_size=500),
        "kpis": lambda: rp.kpis(few),
        "hourly": lambda: rp.hourly(few),
        "station_summary": lambda: rp.station_summary(few),
        "worst_10": lambda: rp.worst(few),
        "selected_range": lambda: rp.select_readings(few, q.SELECTED, *q.SELECTED_DAYS),
        "stream_hourly": lambda: q.stream_hourly_aqi(spark, sf_dir),
    }
    seconds = {}
    for name, build in timed.items():
        for _ in range(2):   # the second run counts: code is compiled, files are cached
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
