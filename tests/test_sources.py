import json

from pyspark.sql import functions as F

from tests.conftest import rows
from voxloom import sources as src
from voxloom.functions.wav import pcm_bytes, pcm_header
from voxloom.operators import segments
from voxloom.operators.existence import manifest_from_tsv
from voxloom.streaming import read_manifest_stream, start_manifest_filter


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_manifest_round_trip(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([("/a.wav", 1.5, "你好"), ("/b.wav", None, 'say "x"')], "audio_filepath string, duration double, text string")
    assert src.write_manifest(df, path) == 2 and src.write_manifest(df, path) == 2
    assert rows(src.read_manifest(spark, path), "audio_filepath", "duration", "text") == rows(df)
    raw = sorted(r.value for r in spark.read.text(path).collect())
    assert raw[0] == '{"audio_filepath":"/a.wav","duration":1.5,"text":"你好"}'


def test_bad_lines_and_row_numbers(spark, tmp_path):
    for name, count in (("a.json", 5), ("b.json", 40)):
        (tmp_path / name).write_text("".join(json.dumps({"audio_filepath": f"{name}{i:02d}", "text": "t"}) + "\n" for i in range(count)))
    (tmp_path / "c.json").write_text("not json\n")
    df = src.read_manifest(spark, str(tmp_path), row_id=True)
    assert [r._corrupt_record for r in df.collect() if r._corrupt_record] == ["not json"]
    names = [r.audio_filepath for r in df.filter("_corrupt_record IS NULL").orderBy("row_id").collect()]
    assert names == sorted(names)
    assert sorted(r.row_id for r in df.collect()) == list(range(46))


def test_row_numbers_over_several_splits(spark, tmp_path):
    (tmp_path / "a.json").write_text("".join(json.dumps({"text": f"{i:04d}"}) + "\n" for i in range(2000)))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = src.read_manifest(spark, str(tmp_path), row_id=True)
        assert [(r.row_id, int(r.text)) for r in df.orderBy("row_id").collect()] == [(i, i) for i in range(2000)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"1")
    files = src.list_files(spark, str(tmp_path), "*.wav")
    assert rows(files, "path", "length") == [(f"{tmp_path}/a.wav", 5)]
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in files._jdf.queryExecution().executedPlan().toString()


def test_csv_lines(spark):
    kept, bad = src.manifest_from_csv(lines(spark, "/d/waves/a.wav,hello,2.5", "/d/waves/b.wav,x, y,2", "c.wav,z,30.5", "waves/waves/d.wav,[UNK],3\n", "e"))
    assert rows(kept) == [("a.wav", 2.5, "hello")]
    assert rows(bad, "audio_filepath", "reason") == [("b.wav", "bad_duration"), ("c.wav", "long"), ("d.wav", "marker"), ("e", "bad_duration")]


def test_tsv(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("client\tpath\tsentence\nq\tx.mp3\t今天（笑）\nq\ty.mp3\tno file\nq\tx.mp3\tagain\n")
    table = src.read_tsv(spark, str(tmp_path / "t.tsv"))
    listing = spark.createDataFrame([("x.wav",)], "path string")
    assert rows(manifest_from_tsv(table, listing, "place")) == [("x.wav", "今天")]


GRID = '''File type = "ooTextFile"
Object class = "TextGrid"

xmin = 0
xmax = 40
tiers? <exists>
size = 2
item []:
    item [1]:
        class = "IntervalTier"
        name = "words"
        intervals: size = 4
        intervals [1]:
            xmin = 0
            xmax = 0.2
            text = "a"
        intervals [2]:
            xmin = 0.2
            xmax = 2.456
            text = "你好 ""ok"""
        intervals [3]:
            xmin = 2.456
            xmax = 3
            text = ""
        intervals [4]:
            xmin = 3
            xmax = 40
            text = "long"
    item [2]:
        class = "TextTier"
        points [1]:
            number = 1
            mark = "p"
'''


def test_textgrid(spark, tmp_path):
    (tmp_path / "A_B_C.TextGrid").write_text(GRID)
    (tmp_path / "A_B.TextGrid").write_text(GRID)
    (tmp_path / "X_Y_Z.TextGrid").write_text("broken")
    kept, bad = src.manifest_from_textgrid(src.read_textgrids(spark, str(tmp_path)))
    assert rows(kept, "audio_filepath", "duration", "text") == [("A_B_C_0000_0.2_2.46.wav", 2.26, '你好 "ok"')]
    assert rows(bad, "reason") == [("long",), ("short",), ("unreadable_file",)]


def test_sanity_lines(spark):
    kept, bad = src.parse_sanity_lines(
        lines(
            spark,
            "x/a.wav: {'cer': 0.12} ref:你好 : pred:你号",
            "AUDIO FILENAME: b.wav |  WER RATE: 0.5 |  DETAILED WER : wer:0.5 | correct %:50.0 |  gt text: a b |  pred text: a c",
            "junk",
        )
    )
    assert rows(kept) == [("b.wav", "wer", 0.5, "a b", "a c"), ("x/a.wav", "cer", 0.12, "你好", "你号")]
    assert rows(bad) == [("junk", "unparsed")]
    text = spark.createDataFrame([("p", "你 好,ab、c")], "audio_filepath string, ref string")
    assert rows(src.sanity_manifest(text)) == [("p", "你 好,ab、c")]
    assert rows(src.sanity_manifest(text, clean=True)) == [("p", "你好 abc")]


def test_subtitles(spark, tmp_path):
    df = spark.createDataFrame([("/s/v1.txt", "{'text': \"it's\", 'start': 0.5, 'duration': 1.2},"), ("/s/v1.txt", "x")], "path string, value string")
    kept, rejects = src.parse_subtitles(df)
    assert rows(kept) == [("v1", "it's", 0.5, 1.2)]
    assert rows(rejects) == [("v1", "x", "unparsed")]
    src.write_subtitles(kept, str(tmp_path / "subs"))
    assert (tmp_path / "subs" / "video_id=v1").is_dir()


def test_text_lines_and_urls(spark):
    assert rows(src.clean_lines(lines(spark, "From: me", "", "single", "two words \n", "single "))) == [("two words",)]
    ids = spark.createDataFrame([("abc",)], "id string")
    assert rows(src.urls_from_ids(ids), "url") == [("https://www.youtube.com/watch?v=abc",)]


def tone(spark, seconds=2.0, rate=16000):
    samples = F.transform(F.sequence(F.lit(0), F.lit(int(seconds * rate) - 1)), lambda i: (i % 100) / 200.0)
    data = pcm_bytes(samples)
    header = pcm_header(F.octet_length(data), F.lit(rate), F.lit(1), F.lit(16))
    return spark.range(1).select(F.lit("/w/rec.wav").alias("path"), F.concat(header, data).alias("content"))


def test_wav(spark, tmp_path):
    import wave

    content = bytes(tone(spark).first().content)
    (tmp_path / "t.wav").write_bytes(content)
    with wave.open(str(tmp_path / "t.wav")) as w:
        assert (w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes()) == (16000, 1, 2, 32000)
    (tmp_path / "bad.wav").write_bytes(b"RIFFxxxxWAVE")
    # Another chunk, of odd length and so with a byte of padding, stands before the samples.
    (tmp_path / "list.wav").write_bytes(content[:36] + b"LIST" + (5).to_bytes(4, "little") + b"INFOx\0" + content[36:])
    known, unknown = src.probe_wav(src.read_wavs(spark, str(tmp_path)))
    assert rows(known.drop("path")) == [rows(known.drop("path"))[0]] * 2
    r = known.first()
    assert (r.sample_rate, r.channels, r.bits, r.data_bytes, r.duration) == (16000, 1, 16, 64000, 2.0)
    assert rows(unknown, "reason") == [("no_pcm_header",)]
    assert rows(segments.audit_format(known), "conforms") == [(True,), (True,)]


def test_cut(spark):
    names = spark.createDataFrame([("rec_0000_0.5_0.75.wav",), ("rec_0000_1.9_9.0.wav",), ("other_0000_0.0_1.0.wav",)], "audio_filepath string")
    tape = tone(spark)
    whole = bytes(tape.first().content)[44:]
    odd = spark.createDataFrame([("plain.wav",), ("bad_0000_0.0_1.0.wav",)], "audio_filepath string")
    bad = spark.createDataFrame([("/w/bad.wav", bytearray(b"RIFFxxxxWAVE"))], "path string, content binary")
    cut, lost = segments.cut_segments(names.unionByName(odd), tape.unionByName(bad))
    assert rows(lost) == [("bad_0000_0.0_1.0.wav", "no_pcm_header"), ("other_0000_0.0_1.0.wav", "no_recording"), ("plain.wav", "bad_name")]
    got = {r.audio_filepath: (r.data_bytes, bytes(r.content)) for r in cut.collect()}
    assert set(got) == {"rec_0000_0.5_0.75.wav", "rec_0000_1.9_9.0.wav"}
    size, content = got["rec_0000_0.5_0.75.wav"]
    assert size == 8000 and content[44:] == whole[16000:24000] and content[40:44] == (8000).to_bytes(4, "little")
    assert got["rec_0000_1.9_9.0.wav"][0] == 3200
    plan = segments.work_plan(names, "trim", "/out/").collect()[0]
    assert (plan.source, plan.target, plan.seg_start, plan.seg_end) == ("rec.wav", "/out/rec_0000_0.5_0.75.wav", 0.5, 0.75)


def test_reports_steps_shards_splits(spark, tmp_path):
    scores = spark.createDataFrame([("c1", "a", 50.0, 50.0, 0.0, 50.0, 0.0)], "checkpoint string, audio_filepath string, wer double, cor_pct double, del_pct double, sub_pct double, ins_pct double")
    src.write_score_report(scores, str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r/text")).first().value == "a  |  WER: 50.00  |  COR: 50.00  |  DEL: 0.00  |  SUB: 50.00  |  INS: 0.00"
    for step, n in ((1, 3), (2, 4), (2, 5)):
        src.append_step_scores(spark.range(n), step, str(tmp_path / "steps"))
    steps = spark.read.parquet(str(tmp_path / "steps")).groupBy("step").count()
    assert rows(steps) == [(1, 3), (2, 5)]
    df = spark.range(90).select(F.concat(F.lit("f"), "id").alias("audio_filepath"), F.lit("t").alias("text"))
    src.write_shards(df, str(tmp_path / "sh"), 3)
    assert spark.read.json(str(tmp_path / "sh")).groupBy("shard").count().count() == 3
    src.write_splits(df.withColumn("split", F.when(F.col("audio_filepath") < "f5", "train").otherwise("test")), str(tmp_path / "sp"))
    back = src.read_splits(spark, str(tmp_path / "sp"))
    assert back.count() == 90
    plan = back.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    listing = df.select(F.col("audio_filepath").alias("path"))
    assert rows(src.preflight(spark.range(2), df, listing)) == [(2, 0, True)]


def test_stream(spark, tmp_path):
    from voxloom.plans import manifest_reason

    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    for n, text in enumerate(["good text", "bad # text"]):
        (inbox / f"{n}.json").write_text(json.dumps({"audio_filepath": f"{n}.wav", "duration": 2.0, "text": text}) + "\n")
        query = start_manifest_filter(read_manifest_stream(spark, str(inbox)), manifest_reason(), out, str(tmp_path / "cp"), once=True)
        query.awaitTermination()
    assert rows(spark.read.json(out), "audio_filepath") == [("0.wav",)]
