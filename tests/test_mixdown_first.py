"""Samples mixed in frames, and first rows of keys over batches that arrive."""

import numpy as np
import pytest

from tests.conftest import rows
from voxloom.functions import pcm
from voxloom.operators import dedupe, mixdown, resample
from voxloom.sources import wav_ranges
from voxloom.streaming import first_arrivals, start_batches


@pytest.fixture(scope="module")
def tapes():
    rng = np.random.default_rng(4)
    return {f"t{k}": rng.integers(-20000, 20000, n).astype("<i2") for k, n in enumerate((1, 7, 64, 65, 200, 0))}


def slow_mix(tracks, tapes):
    out = {}
    for name, path, at in tracks:
        x = tapes[path].astype(int)
        have = out.get(name, np.zeros(0, int))
        size = max(len(have), at + len(x))
        total = np.zeros(size, int)
        total[: len(have)] = have
        total[at : at + len(x)] += x
        out[name] = total
    return {k: np.clip(x, -32768, 32767) for k, x in out.items()}


def chunked(spark, tapes, size):
    cut = [(p, a, x[a : a + size].tobytes()) for p, x in tapes.items() for a in range(0, max(1, len(x)), size)]
    return spark.createDataFrame([(p, a, bytearray(b)) for p, a, b in cut], "path string, first_out long, pcm binary")


def test_mix_equals_sums(spark, tapes, tmp_path):
    rng = np.random.default_rng(5)
    names, paths = ["a", "b", "with blank", "漢"], list(tapes)
    tracks = [(str(rng.choice(names)), str(rng.choice(paths)), int(rng.integers(0, 900))) for _ in range(60)]
    tracks += [("crowd", "t4", 10)] * 50 + [("late", "t1", 5000), ("nothing", "t5", 0)]
    bad = [(None, "t1", 0), ("a", "t1", -1), ("a", "t1", None), ("a", "gone", 0), ("only bad", None, 0)]
    frame = spark.createDataFrame(tracks + bad, "out string, path string, at long")
    want = slow_mix(tracks, tapes)
    for size, width in ((64, 64), (10, 64), (200, 1000)):
        made = mixdown.mix_down(frame, chunked(spark, tapes, size), width)
        got: dict = {}
        for r in sorted(made.kept.collect(), key=lambda r: (r.out, r.frame)):
            assert r.samples == len(want[r.out])
            got[r.out] = got.get(r.out, b"") + bytes(r.pcm)
        assert set(got) == set(want)
        for k in want:
            assert (np.frombuffer(got[k], "<i2") == want[k]).all()
        assert sorted(r.reason for r in made.rejects.collect()) == ["bad_start", "bad_start", "no_name", "no_recording", "no_recording"]


def test_mix_as_files(spark, tapes, tmp_path):
    inbox, out = tmp_path / "in", tmp_path / "out"
    inbox.mkdir()
    for name in ("t3", "t4"):
        (inbox / f"{name}.wav").write_bytes(pcm.header(2 * len(tapes[name]), 8000, 1, 16) + tapes[name].tobytes())
    probed = wav_ranges.probe_ranges(wav_ranges.wav_listing(spark, str(inbox))).kept
    chunks = resample.convert(probed, 8000, chunk=32)
    place = {r.path.rsplit("/", 1)[1]: r.path for r in probed.collect()}
    plan = spark.createDataFrame([(place["t4.wav"], place["t3.wav"], 0.02)], "first_path string, second_path string, second_start double")
    tracks = mixdown.overtalk_tracks(plan, 8000).withColumn("out", mixdown.F.lit("pair"))
    mixdown.write_mix(mixdown.mix_down(tracks, chunks, 32).kept, str(out), 8000)
    data = (out / "pair.wav").read_bytes()
    want = slow_mix([("pair", "t4", 0), ("pair", "t3", 160)], tapes)["pair"]
    assert data == pcm.header(2 * len(want), 8000, 1, 16) + want.astype("<i2").tobytes()


def test_a_word_without_a_clip_is_a_reject(spark, tapes):
    worded = spark.createDataFrame([("t4", 0, "hm", 0.0, 0.1, False), ("t4", 0, "okay", 0.004, 0.1, True), ("t4", 1, "odd", 0.01, 0.1, True)], "audio_filepath string, pos int, word string, start double, end double, inserted boolean")
    clips = spark.createDataFrame([("okay", "t1")], "word string, path string")
    made = mixdown.mix_down(mixdown.backchannel_tracks(worded, clips, 1000), chunked(spark, tapes, 64), 64)
    got = b"".join(bytes(r.pcm) for r in sorted(made.kept.collect(), key=lambda r: r.frame))
    assert (np.frombuffer(got, "<i2") == slow_mix([("t4", "t4", 0), ("t4", "t1", 4)], tapes)["t4"]).all()
    assert [(r.at, r.reason) for r in made.rejects.collect()] == [(10, "no_recording")]
    empty = mixdown.mix_down(mixdown.backchannel_tracks(worded.limit(0), clips, 1000), chunked(spark, tapes, 64))
    assert empty.kept.count() == empty.rejects.count() == 0


def test_first_arrivals_over_restarts(spark, tmp_path):
    schema = "row_id int, text string, note string"
    parts = [
        [(5, "a", "x"), (3, "a", "y"), (4, None, "n"), (9, "", "e")] + [(100 + k, "hot", "h") for k in range(3000)],
        [(1, "a", "late"), (2, "b", "z"), (8, None, "late"), (None, "c", "null order"), (7, "c", "seven")] + [(k + 4000, "hot", "h") for k in range(3000)],
        [(0, "b", "late"), (6, "d", "d"), (0, "hot", "late")],
    ]
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "out", "checkpoint"))
    for part in parts:
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(inbox)
        query = start_batches(first_arrivals(spark.readStream.schema(schema).parquet(inbox), "text"), out, checkpoint, once=True)
        query.awaitTermination()
    got = rows(spark.read.schema(schema).parquet(out), "row_id", "text", "note")
    assert got == sorted([(3, "a", "y"), (4, None, "n"), (9, "", "e"), (100, "hot", "h"), (2, "b", "z"), (7, "c", "seven"), (6, "d", "d")], key=repr)


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    """The checkpoint forgets that a batch was committed, as after a failure between writing and committing."""
    schema = "row_id int, text string"
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "out", "checkpoint"))

    def run():
        rows_in = spark.readStream.schema(schema).parquet(inbox)
        start_batches(first_arrivals(rows_in, "text"), out, checkpoint, once=True).awaitTermination()
        return rows(spark.read.schema(schema).parquet(out), "row_id", "text")

    for k in range(2):
        spark.createDataFrame([(k * 10 + x, f"t{x + k}") for x in range(4)], schema).coalesce(1).write.mode("append").parquet(inbox)
        want = run()
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    for mark in (tmp_path / "checkpoint" / "commits").glob(f".{commits[-1].name}.*"):
        mark.unlink()
    assert run() == want == sorted([(0, "t0"), (1, "t1"), (2, "t2"), (3, "t3"), (13, "t4")], key=repr)


def test_first_by_text_deals_by_digest(spark):
    df = spark.createDataFrame([(2, "a"), (1, "a"), (3, None), (0, None), (5, "")], "row_id int, text string")
    got = dedupe.first_by_text(df)
    assert got.columns == ["row_id", "text"] and rows(got) == [(0, None), (1, "a"), (5, "")]


def test_arrivals_reach_python_in_small_batches(spark, tmp_path):
    """Batches of whole texts are bounded in rows and bytes, whatever the session had."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    kept = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "10000")
        spark.conf.set(names[1], "64MB")
        first_arrivals(spark.readStream.schema("row_id long, text string").parquet(str(tmp_path)), "text")
        assert [int(spark.conf.get(n)) for n in names] == [500, 4 << 20]
    finally:
        for n, value in zip(names, kept):
            spark.conf.set(n, value)
