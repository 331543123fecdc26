"""What the planner makes of the operators: pushed filters, pruned columns, early rank limits, single scoring."""

import pytest
from pyspark.sql import functions as F

from voxloom.operators import dedupe, filters, keywords
from voxloom.operators.scoring import pair_cer
from voxloom.plans import checkpoint_report, clean_manifest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def manifest(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plan") / "m")
    rows = spark.range(50).select(
        F.col("id").alias("row_id"),
        F.concat(F.lit("/a/"), "id", F.lit(".wav")).alias("audio_filepath"),
        (F.col("id") / 2.0).alias("duration"),
        F.lit("some text").alias("text"),
        F.lit("unused").alias("extra"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_band_reaches_the_scan(manifest):
    for kept in (filters.duration_band(manifest, "duration", 1, 30).kept, clean_manifest(manifest).kept):
        assert "GreaterThanOrEqual(duration,1.0), LessThanOrEqual(duration,30.0)" in plan(kept)


def test_columns_are_pruned(manifest):
    assert "ReadSchema: struct<audio_filepath:string>" in plan(dedupe.duplicate_names(manifest))


def test_rank_limits_run_before_the_shuffle(manifest):
    assert "WindowGroupLimit" in plan(dedupe.first_by(manifest, "text")).split("Exchange")[-1]
    picked = plan(keywords.select_by_keywords(manifest, ["some", "text"]))
    assert "WindowGroupLimit" in picked and "Join" not in picked


def test_scores_are_computed_once(spark, manifest):
    pairs = manifest.select("audio_filepath", F.col("text").alias("ref"), F.lit("other").alias("hyp"))
    low = plan(filters.below_rate(pair_cer(pairs), "cer").kept)
    assert low.count("ArrowEvalPython") == 1 and low.index("ArrowEvalPython") < low.index("RoundRobinPartitioning")
    heard = manifest.select(F.lit("c").alias("checkpoint"), "audio_filepath", F.col("text").alias("hyp"))
    assert plan(checkpoint_report(manifest, heard)).count("ArrowEvalPython") == 1
