"""Times the headline steps and prints one line of JSON.

Environment: BENCH_SF_DIR (folder of tables, default sf0.1) and BENCH_CPUS (default 8). Each step
reads the written table of the step before, as in a pipeline, and its whole result is produced.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from reviewrank.operators import ensemble, evaluate, features, forest, queue, ranking, rules  # noqa: E402
from reviewrank.plans import views  # noqa: E402
from reviewrank.session import local_session, written  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores), memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start-up is not measured
    seconds: dict[str, float] = {}

    def timed(name, step):
        started = time.time()
        result = step()
        seconds[name] = round(time.time() - started, 3)
        return result

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    timed("collapse_segments", lambda: views.claims(spark, folder))
    injected = timed("collapse_and_inject", lambda: views.injected(spark, folder))
    featured = timed("claim_features", lambda: written(features.claim_features(injected), "features"))
    ruled = rules.score_rules(featured, views.RULES)
    timed("rule_score", lambda: noop(ruled))
    scored = written(ruled.withColumn("model_anomaly_score", views.fixed_model_score()), "ruled")
    timed("avg_rank_pct", lambda: noop(ranking.with_avg_rank_pct(scored, "model_anomaly_score", "share")))
    ranked = timed("ensemble_rank", lambda: written(ensemble.combine_scores(scored), "ranked"))
    timed("compare_strategies", lambda: evaluate.compare_strategies(ranked).collect())
    visible = queue.filter_queue(queue.prepare_queue(ranked))
    timed("queue_kpis", lambda: queue.summarize_queue(visible).collect())
    timed("feature_statistics", lambda: forest.fit_preparation(featured))
    model, _ = timed("forest_training", lambda: forest.train_model(featured))
    timed("forest_scoring", lambda: noop(forest.with_raw_score(featured, model)))
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total time of headline steps", "value": total, "unit": "sec", "queries": seconds, "sf": Path(folder).name, "cpus": int(cores), "claims": featured.count()}))
    spark.stop()


if __name__ == "__main__":
    main()
