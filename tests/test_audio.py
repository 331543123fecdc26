"""Files per key, WAV files by ranges, and conversion, on fixtures."""

import math
import struct
from urllib.parse import unquote

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from voxloom.functions.wav import pcm_bytes
from voxloom.functions import pcm
from voxloom.functions.wav import pcm_info
from voxloom.operators import resample
from voxloom.sources import keyed_files, wav_ranges


def wav(samples: bytes, rate=16000, channels=1, bits=16, tag=1, before=b""):
    head = pcm.header(len(samples), rate, channels, bits, tag)
    return head[:36] + before + head[36:] + samples


def chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


# --- files per key


def test_names_of_files():
    for key in ("a.txt", "x/y", "..", ".", "_temporary", "", "漢 字.txt", "100%", "a\\b", "a:b", "~"):
        name = keyed_files.file_name(key)
        assert keyed_files.key_of(name) == key and "/" not in name and not name.startswith(("_", "."))


def test_a_file_per_key(spark, tmp_path):
    folder = str(tmp_path / "subs")
    df = spark.createDataFrame([(f"k{n % 7}", n, f"line {n}\n") for n in range(700)] + [(None, 1, "x"), ("", 2, "y"), ("a/b", 3, None)], "k string, n int, t string").repartition(9)
    left = keyed_files.write_keyed(df, folder, F.col("k"), F.col("t"), ["n"])
    assert rows(left) == [("", 2, "y"), (None, 1, "x")]
    found = {p.name: p.read_text() for p in (tmp_path / "subs").iterdir()}
    assert found == {f"k{k}": "".join(f"line {n}\n" for n in range(k, 700, 7)) for k in range(7)} | {"a%2Fb": ""}
    # Added to, one name written again; then written over.
    keyed_files.write_keyed(spark.createDataFrame([("k1", "new"), ("z", "z")], "k string, t string"), folder, F.col("k"), F.col("t"), mode="append")
    found = {p.name: p.read_text() for p in (tmp_path / "subs").iterdir()}
    assert found["k1"] == "new" and found["z"] == "z" and len(found) == 9
    keyed_files.write_keyed(df.limit(0), folder, F.col("k"), F.col("t"))
    assert list((tmp_path / "subs").iterdir()) == []


def test_only_attempts_that_count_are_published(tmp_path):
    import pyarrow as pa

    def batch(*pairs):
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in pairs]), pa.array([v for _, v in pairs], pa.binary())], ["name", "content"])

    folder = tmp_path / "out"
    writer = keyed_files.KeyedWriter(str(folder), True)

    def broken():
        yield batch(("a", b"1"), ("b", b"2"))
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(broken())
    slow = writer.write(iter([batch(("a", b"1"), ("b", b"2"))]))
    good = writer.write(iter([batch(("a", b"1"), ("a", b"+")), batch(("a", b"!"), ("b", b"2"))]))
    assert slow.files == good.files == 2 and sorted(p.name for p in folder.iterdir()) == [writer.work.rsplit("/", 1)[1]]
    writer.commit([good, None, writer.write(iter([]))])
    assert {p.name: p.read_bytes() for p in folder.iterdir()} == {"a": b"1+!", "b": b"2"}
    failed = keyed_files.KeyedWriter(str(folder), True)
    failed.abort([failed.write(iter([batch(("c", b"3"))]))])
    assert sorted(p.name for p in folder.iterdir()) == ["a", "b"]
    with pytest.raises(ValueError, match="one stretch"):
        failed.write(iter([batch(("a", b"1"), ("b", b"2"), ("a", b"3"))]))


def test_subtitles_read_back(spark, tmp_path):
    from voxloom.sources import parse_subtitles

    texts = ["it's \"so\"", "back\\slash", "two\nlines\r", "", None, "漢字, {'text': 'x'}"]
    df = spark.createDataFrame([("v/1" if n % 2 else "v2", t, n / 4, 0.5) for n, t in enumerate(texts)] + [(None, "x", 0.0, 1.0), ("v2", "x", None, 1.0)], "video_id string, text string, start double, duration double")
    kept, lost = keyed_files.write_subtitle_files(df, str(tmp_path / "s"))
    assert rows(lost, "reason") == [("no_id",), ("no_time",)] and kept.count() == 6
    lines = spark.read.text(str(tmp_path / "s")).select(F.col("_metadata.file_name").alias("path"), "value")
    # Spark gives names of files as parts of URIs.
    got = sorted((keyed_files.key_of(unquote(r.video_id)), r.start, r.text) for r in parse_subtitles(lines).kept.collect())
    assert got == sorted(("v/1" if n % 2 else "v2", n / 4, t or "") for n, t in enumerate(texts))


# --- byte ranges


@pytest.fixture
def tapes(tmp_path):
    tone = (np.arange(160_000) % 251 - 125).astype("<i2")
    folder = tmp_path / "tapes"
    folder.mkdir()
    notes = b"".join(chunk(b"NOTE", bytes([k % 256])) for k in range(300))
    files = {
        "long.wav": wav(tone.tobytes()),
        "many chunks.wav": wav(tone.tobytes(), before=notes),
        "float.wav": wav((tone / 32768).astype("<f4").tobytes(), bits=32, tag=3),
        "wide.wav": wav(np.repeat(tone, 2).tobytes(), channels=2),
        "cut.wav": wav(tone.tobytes())[:1045],
        "empty.wav": wav(b""),
        "no.wav": b"RIFFxxxxWAVE" + chunk(b"data", b"1234"),
        "text.wav": b"hello",
        "law.wav": wav(b"1234", bits=8, tag=7),
        "zero.wav": wav(b"1234", rate=0),
    }
    # The format of the samples in the longer form of its chunk.
    long_form = struct.pack("<HHIIHHHHIH", pcm.EXTENSIBLE, 1, 16000, 32000, 2, 16, 22, 16, 4, pcm.INTEGERS) + b"\0" * 14
    files["long form.wav"] = b"RIFF\0\0\0\0WAVE" + chunk(b"fmt ", long_form) + chunk(b"data", tone.tobytes())
    for name, content in files.items():
        (folder / name).write_bytes(content)
    return folder, tone, files


def test_probe_reads_heads_only(spark, tapes):
    folder, tone, files = tapes
    listed = wav_ranges.wav_listing(spark, str(folder))
    missing = spark.createDataFrame([(f"file:{folder}/gone.wav", 1), (None, 1)], listed.schema)
    kept, lost = wav_ranges.probe_ranges(listed.unionByName(missing))
    got = {r.path.rsplit("/", 1)[1]: r for r in kept.collect()}
    assert {r.path and r.path.rsplit("/", 1)[1]: r.reason for r in lost.collect()} == {
        "no.wav": "no_pcm_header", "text.wav": "no_pcm_header", "law.wav": "no_pcm_header", "zero.wav": "no_pcm_header", "gone.wav": "unreadable", None: "no_path",
    }
    assert {n: (r.channels, r.bits, r.tag, r.data_bytes) for n, r in got.items()} == {
        "long.wav": (1, 16, 1, 320000), "many chunks.wav": (1, 16, 1, 320000), "float.wav": (1, 32, 3, 640000), "wide.wav": (2, 16, 1, 640000),
        "cut.wav": (1, 16, 1, 1001), "empty.wav": (1, 16, 1, 0), "long form.wav": (1, 16, 1, 320000),
    }
    assert got["long.wav"].duration == 10.0 and got["wide.wav"].duration == 10.0 and got["empty.wav"].duration == 0.0
    assert all(r.bytes_read <= 4096 for n, r in got.items()) and files["many chunks.wav"][got["many chunks.wav"].data_at - 8 :][:4] == b"data"


def test_heads_far_into_a_file():
    content = wav(b"\1\2", before=chunk(b"JUNK", b"x" * 100_000) + b"".join(chunk(b"NOTE", b"12345") for _ in range(1000)))
    asked = []
    pages = pcm.Pages(lambda at, n: asked.append((at, n)) or content[at : at + n], len(content))
    found = pcm.find_samples(pages)
    assert found.data_bytes == 2 and content[found.data_at :] == b"\1\2"
    assert pages.taken == sum(n for _, n in asked) < 4096 + 1002 * 64


def test_whole_content_with_any_number_of_chunks(spark):
    content = wav(b"\1\2\3\4", before=b"".join(chunk(b"NOTE", b"1234") for _ in range(400)))
    info = spark.createDataFrame([(bytearray(content),)], "c binary").select(pcm_info(F.col("c")).alias("i")).first().i
    assert info.data_bytes == 4 and content[info.data_at - 1 :] == b"\1\2\3\4"


def test_cuts_read_only_their_bytes(spark, tapes, monkeypatch):
    folder, tone, _ = tapes
    probed = wav_ranges.probe_ranges(wav_ranges.wav_listing(spark, str(folder))).kept
    names = ["long_0000_1.0_1.5.wav", "long_0000_9.5_99.0.wav", "long_0000_20.0_30.0.wav", "many chunks_0000_0.0_0.25.wav", "float_0000_2.0_2.5.wav", "wide_0000_0.5_0.75.wav", "gone_0000_0.0_1.0.wav", "plain.wav"]
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "audio_filepath string, path int")
    plans = []
    dealt = wav_ranges.dealt_by_bytes
    monkeypatch.setattr(wav_ranges, "dealt_by_bytes", lambda ranges: plans.append(dealt(ranges)) or plans[-1])
    cut, lost = wav_ranges.cut_ranges(df, probed)
    assert rows(lost, "audio_filepath", "reason") == [("gone_0000_0.0_1.0.wav", "no_recording"), ("plain.wav", "bad_name")]
    got = {r.audio_filepath: bytes(r.content) for r in cut.collect()}
    assert got["long_0000_1.0_1.5.wav"] == wav(tone[16000:24000].tobytes())
    assert got["long_0000_9.5_99.0.wav"] == wav(tone[152000:].tobytes()) and got["long_0000_20.0_30.0.wav"] == wav(b"")
    assert got["many chunks_0000_0.0_0.25.wav"] == wav(tone[:4000].tobytes())
    assert got["float_0000_2.0_2.5.wav"] == wav((tone[32000:40000] / 32768).astype("<f4").tobytes(), bits=32, tag=3)
    assert got["wide_0000_0.5_0.75.wav"] == wav(np.repeat(tone[8000:12000], 2).tobytes(), channels=2)
    # What was asked for is what the segments hold, not a byte more.
    assert sum(r._bytes for r in plans[0].collect()) == sum(len(c) - 44 for c in got.values())


def test_ranges_are_dealt_by_bytes(spark):
    df = spark.createDataFrame([(f"/f{k % 5}", k * 100, 100) for k in range(1000)], "_path string, _first long, _bytes long")
    plan = wav_ranges.dealt_by_bytes(df, stripe=5000)
    assert rows(plan) == rows(df) and len(plan.inputFiles()) > 10
    assert wav_ranges.dealt_by_bytes(df.limit(0)).count() == 0


# --- conversion


def slow_resample(x, up, down, n):
    """The definition, sample by sample."""
    if up == down:
        return np.array(x[:n], float)
    cut, out = resample.BAND * min(1, up / down), []
    for m in range(n):
        total = norm = 0.0
        for k in range(m * down // up - 2 * resample.half_width(up, down), m * down // up + 2 * resample.half_width(up, down)):
            t = k - m * down / up
            if abs(t) < resample.ZEROS / cut:
                g = np.sinc(cut * t) * math.cos(math.pi * t * cut / (2 * resample.ZEROS)) ** 2
                norm += g
                total += g * x[k] if 0 <= k < len(x) else 0
        out.append(total / norm)
    return np.array(out)


@pytest.mark.parametrize("rate_in,rate_out", [(8000, 16000), (44100, 16000), (48000, 16000), (16000, 16000), (22050, 16000), (11025, 8000), (7, 16)])
def test_resample_equals_its_definition(rate_in, rate_out):
    up, down = resample.ratio(rate_in, rate_out)
    x = np.random.default_rng(rate_in).normal(size=400) * 1000
    n = -(-400 * up // down)
    assert np.allclose(resample.resample(x, 0, 0, n, up, down), slow_resample(x, up, down, n), atol=1e-8)


def test_tones_stay_and_others_go():
    t = np.arange(44100) / 44100
    up, down = resample.ratio(44100, 16000)
    inner = slice(200, 15800)
    low = resample.resample(np.sin(2 * np.pi * 440 * t), 0, 0, 16000, up, down)
    assert np.abs(low - np.sin(2 * np.pi * 440 * np.arange(16000) / 16000))[inner].max() < 1e-3
    # 12 kHz does not fit below half of 16 kHz and would sound as 4 kHz.
    assert np.abs(resample.resample(np.sin(2 * np.pi * 12000 * t), 0, 0, 16000, up, down))[inner].max() < 2e-3


def test_sample_formats():
    x = np.array([-32768, -1, 0, 1, 258, 32767])
    assert (pcm.decode(x.astype("<i2").tobytes(), 1, 16, 1)[:, 0] == x).all()
    assert (pcm.decode((x * 65536).astype("<i4").tobytes(), 1, 32, 1)[:, 0] == x).all()
    assert (pcm.decode(b"".join((int(v) * 256).to_bytes(3, "little", signed=True) for v in x), 1, 24, 1)[:, 0] == x).all()
    assert (pcm.decode(bytes([0, 128, 255, 7]), 2, 8, 1) == [[-32768, 0], [32512, -30976]]).all()
    assert (pcm.decode((x / 32768).astype("<f8").tobytes(), 1, 64, 3)[:, 0] == x).all()
    assert np.frombuffer(pcm.encode16(np.array([0.5, -0.5, 40000, -40000, 1.49])), "<i2").tolist() == [1, 0, 32767, -32768, 1]
    assert pcm.decode(b"\1", 1, 16, 1).shape == (0, 1)


def test_chunks_equal_the_whole(spark, tapes, tmp_path):
    folder, tone, files = tapes
    rng = np.random.default_rng(1)
    noise = (rng.normal(size=30_000) * 8000).clip(-32768, 32767).astype("<i2")
    (folder / "fast.wav").write_bytes(wav(noise.tobytes(), rate=44100, channels=2))
    (folder / "slow.wav").write_bytes(wav(noise.tobytes(), rate=11025))
    probed = wav_ranges.probe_ranges(wav_ranges.wav_listing(spark, str(folder))).kept
    read = lambda out: {p.name: p.read_bytes() for p in out.iterdir()}
    resample.write_converted(probed, str(tmp_path / "one"), chunk=1 << 20)
    resample.write_converted(probed, str(tmp_path / "many"), chunk=977)
    one = read(tmp_path / "one")
    assert one == read(tmp_path / "many") and set(one) == {r.path.rsplit("/", 1)[1] for r in probed.collect()}
    assert one["long.wav"] == one["wide.wav"] == one["float.wav"] == one["many chunks.wav"] == files["long.wav"] and one["empty.wav"] == wav(b"")
    want = resample.resample(noise.reshape(-1, 2).mean(1), 0, 0, -(-15_000 * 160 // 441), 160, 441)
    assert one["fast.wav"] == wav(pcm.encode16(want))
    assert one["slow.wav"] == wav(pcm.encode16(resample.resample(noise.astype(float), 0, 0, -(-30_000 * 640 // 441), 640, 441)))


def test_short_files_are_dealt_by_their_number(spark):
    """By bytes alone three thousand short files are one task."""
    from voxloom.sources.wav_ranges import dealt_by_bytes

    ranges = spark.range(3000).select(F.concat(F.lit("/w/"), "id").alias("_path"), F.lit(0).cast("long").alias("_first"), F.lit(100).cast("long").alias("_bytes"))
    dealt = dealt_by_bytes(ranges)
    assert dealt.count() == 3000 and len(dealt.inputFiles()) > 1


def test_samples_are_packed_as_before(spark):
    """Halves away from zero, what is no number or missing as the loudest, null and empty lists."""
    rows = [[0.5 / 32767, -0.5 / 32767, 2.0, -2.0, float("nan"), None, float("-inf")], [], None]
    packed = spark.createDataFrame([(r,) for r in rows], "x array<double>").select(pcm_bytes(F.col("x")).alias("b"))
    assert [None if r.b is None else list(memoryview(bytes(r.b)).cast("h")) for r in packed.collect()] == [[1, -1, 32767, -32767, 32767, 32767, -32767], [], None]


def test_flags_are_hashed_not_sorted(spark, tmp_path):
    from voxloom.checks.catalog import QUERIES

    rows = [(1, "A"), (1, None), (2, "A"), (2, "N"), (3, "N"), (3, "R"), (4, None), (5, "B"), (5, "A")] + [(k, "A") for k in (6, 6, 6, 6)]
    spark.createDataFrame(rows, "l_orderkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["c8_label_length"](spark, str(tmp_path))
    assert "SortAggregate" not in found._jdf.queryExecution().toString()
    assert {tuple(r) for r in found.collect()} == {(k, "kept") for k in range(1, 6)} | {(6, "label_length")}
