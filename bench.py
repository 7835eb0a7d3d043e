"""Wall time of the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import time

from adloom.session import get_session
from adloom.suite import QUERIES

HEADLINE = [
    "enc_table", "enc_table_rates", "enc_vocab", "enc_seq_vocab", "enc_sequence_pre", "enc_sequence_post", "enc_minmax",
    "enc_quantile_bucket", "spl_hash", "spl_stratified", "spl_sequential", "idx_row_index", "smp_hash_n",
    "agg_cat_summary", "agg_describe", "agg_corr_matrix", "agg_nunique", "agg_token_topk", "agg_seq_stats",
    "met_logloss", "met_auc", "met_ap", "met_gauc", "met_mrr", "met_ndcg", "met_score", "met_compare", "met_evaluate",
    "vec_sum_pool", "vec_kmax", "vec_fm", "vec_inner", "vec_attention", "sub_meanfill", "win_topk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY", "").split()
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query loads the classes that every later one shares.
    QUERIES["met_auc"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
