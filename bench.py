"""Runs headline queries and prints one JSON line with seconds for each."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from foliospark.plans import registry  # noqa: E402
from foliospark.session import session  # noqa: E402

HEADLINE = ("c7_c9_concordance", "c4_near", "b3_b7_scored_pairs", "d4_query_scores", "d5_top_cases", "f13_packed", "g7_average_precision", "j4_fold", "j15_tally")
LLM = ("op1_quality_rules", "op2_minhash_near_dedup", "op5_byte_bpe", "op6_mix_sources", "op8_pii_pseudonyms", "op9_licence_scan", "op10_ann_prefix_forest", "op11_best_fit_packing", "op12_conversation_trie", "op13_hard_negatives")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session("bench", master=f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    queries = dict(registry.queries())
    names = list(HEADLINE)
    try:
        from foliospark.llm.queries import QUERIES

        queries |= QUERIES
        names += LLM
    except ImportError:
        pass
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seconds = {}
    for name in names:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
