"""Headline queries timed on one machine; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from voxloom.checks.catalog import QUERIES
from voxloom.session import local_session

HEADLINE = [
    "p2_checkpoint_report",
    "c7_sanity_check",
    "t15_word_alignment",
    "t15_word_distance",
    "e8_micro_cer",
    "e9_loan_word_scores",
    "t9_tokenize_mixed",
    "t10_normalize",
    "c3_special_characters",
    "p1_clean_manifest",
    "a3_csv_lines",
    "d1_file_exists",
    "d3_keyword_join",
    "d3_long_keyword_list",
    "f1_first_by_text",
    "f2_keyword_select",
    "e1_duration_report",
    "e4_duplicate_rows",
    "f5_pad_batches",
    "h3_split_sets",
    "t13_py_round",
    "t26_augment",
    "x1_keyword_sentences",
    "x4_join_neighbours",
    "x5_overtalk",
    "x6_backchannels",
]


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    # One run of the flagship starts the Python workers and the compiler; it is not counted.
    timed(spark, folder, HEADLINE[0])
    seconds = {name: round(timed(spark, folder, name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
