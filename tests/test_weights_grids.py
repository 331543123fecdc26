"""Splits by weight that keep groups whole, and TextGrid files in the short layout."""

from pyspark.sql import functions as F

from tests.conftest import rows
from voxloom.operators import sampling
from voxloom.sources import textgrid


def test_splits_by_weight(spark):
    hours = [(f"s{k % 40}", (k * 37 % 101) / 7 if k % 13 else None, k) for k in range(2000)] + [("big", 20000.0, -1), (None, 5.0, -2), (None, 6.0, -3), ("neg", -4.0, -4), ("zero", 0.0, -5)]
    df = spark.createDataFrame(hours, "speaker string, hours double, k long").repartition(7)
    got = sampling.weighted_split(df, "speaker", "hours", (("train", 0.5), ("test", 0.25), ("validation", 0.25)), seed=3)
    assert got.count() == len(hours) and got.groupBy("speaker").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    places = {r.speaker: (int(r.w), int(r.before), int(r.total)) for r in sampling.weighted_places(df, "speaker", "hours", seed=3).collect()}
    weight = {}
    for s, h, _ in hours:
        weight[s] = weight.get(s, 0) + max(0, int((h or 0) * 1000 + 0.5))
    assert {s: p[0] for s, p in places.items()} == weight
    at = 0
    for s, (w, before, total) in sorted(places.items(), key=lambda x: (x[1][1], x[1][1] + x[1][0])):
        assert before == at and total == sum(weight.values())
        at += w
    split = {r.speaker: r.split for r in got.select("speaker", "split").distinct().collect()}
    total, reached = sum(weight.values()), 0
    for name, share in (("train", 0.5), ("test", 0.25), ("validation", 0.25)):
        mine = sum(w for s, w in weight.items() if split[s] == name)
        # Off by half of the group that lies over either cut.
        assert abs(mine - share * total) <= max(weight.values())
    again = sampling.weighted_split(df.repartition(3), "speaker", "hours", (("train", 0.5), ("test", 0.25), ("validation", 0.25)), seed=3)
    assert rows(again) == rows(got)
    for empty in (df.limit(0), df.filter("k = -5")):
        assert sampling.weighted_split(empty, "speaker", "hours").count() == empty.count()


def test_groups_by_weight(spark):
    df = spark.range(3000).select((F.col("id") % 300).alias("g"), (F.col("id") % 11).cast("double").alias("w"))
    shares = {r.shard: r.w for r in sampling.weighted_groups(df, 5, "g", "w").groupBy("shard").agg(F.sum("w").alias("w")).collect()}
    assert set(shares) == set(range(5)) and max(shares.values()) - min(shares.values()) <= 2 * 110


SHORT = '''File type = "ooTextFile"
Object class = "TextGrid"

0
41
<exists>
3
"TextTier"
"marks"
0
41
2
0.5
"IntervalTier"
1.5
"say ""x"""
"IntervalTier"
"words [3]"
0
41
4
0
0.2
"a"
0.2
2.456
"你好 ""ok""
next line 7 <exists>"
2.456
3
""
3
40
"long"
"IntervalTier"
"none"
0
41
0
'''


def test_short_layout(spark, tmp_path):
    (tmp_path / "A_B_C.TextGrid").write_text(SHORT)
    (tmp_path / "A_B_D.TextGrid").write_bytes(b"\xff\xfe" + SHORT.encode("utf-16-le"))
    (tmp_path / "A_B_E.TextGrid").write_bytes(b"\xfe\xff" + SHORT.encode("utf-16-be"))
    (tmp_path / "A_B_F.TextGrid").write_bytes(b"\xef\xbb\xbf" + SHORT.replace("\n", "\r\n").encode())
    (tmp_path / "A_B_G.TextGrid").write_text(SHORT[: SHORT.index("3\n40")])
    (tmp_path / "A_B_H.TextGrid").write_text(SHORT.replace("<exists>\n3", "<exists>\nthree"))
    (tmp_path / "A_B_I.TextGrid").write_text('File type = "ooTextFile"\nObject class = "TextGrid"\n\n0\n1\n<exists>\n0\n')
    (tmp_path / "A_B_J.TextGrid").write_bytes(b"\xff\xfe\x41")
    # A file of no bytes is passed over by Spark itself.
    (tmp_path / "A_B_K.TextGrid").write_text("")
    kept, bad = textgrid.manifest_from_textgrid(textgrid.read_textgrids(spark, str(tmp_path)))
    text = '你好 "ok"\nnext line 7 <exists>'
    assert rows(kept, "audio_filepath", "duration", "text") == [(f"A_B_{x}_0000_0.2_2.46.wav", 2.26, text.replace("\n", "\r\n") if x == "F" else text) for x in "CDEF"]
    refused = {r.path.rsplit("/", 1)[1][4]: r.reason for r in bad.filter("reason = 'unreadable_file'").collect()}
    assert refused == dict.fromkeys("GHJ", "unreadable_file")
    assert bad.filter("reason IN ('short', 'long')").count() == 8
