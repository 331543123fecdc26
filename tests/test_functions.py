import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, value
from voxloom import functions as fn
from voxloom.functions.numbers import to_number


def test_py_round_matches_python(spark):
    random.seed(3)
    numbers = [0.0625, 2.675, 0.125, 0.375, -0.0625, 0.0, 2.5, 1e15 + 0.5, 0.0125, 0.0005, 1.005, 1e300]
    numbers += [random.randint(0, 4000) / random.choice([16, 80, 400, 2000, 7]) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    got = df.select("x", *[fn.py_round(F.col("x"), d).alias(f"d{d}") for d in (0, 2, 3)]).collect()
    assert all((r.d0, r.d2, r.d3) == (round(r.x, 0), round(r.x, 2), round(r.x, 3)) for r in got)


@pytest.mark.parametrize("text,number", [("2.5", 2.5), (" 2.5\n", 2.5), ("1e2", 100.0), (" y", None), ("", None), ("1d", None), ("-.5", -0.5)])
def test_to_number(spark, text, number):
    assert value(spark, lambda c: to_number(c), c=text) == number


def test_names(spark):
    assert value(spark, lambda c: fn.base_name(c), c="/p/q/a.wav") == "a.wav"
    assert value(spark, lambda c: fn.swap_ext(c, ".mp3", ".wav"), c="clip.mp3") == "clip.wav"
    assert value(spark, lambda c: fn.bracket_id(c), c="/yt/Some title [aB-3_x].wav") == "aB-3_x"
    assert value(spark, lambda c: fn.bracket_id(c), c="plain.wav") is None
    assert value(spark, lambda c: fn.safe_int(c), c="z23") is None
    assert value(spark, lambda c: fn.safe_int(c), c="023") == 23
    rules = [("common_voice", "/home/wavs/"), ("nst_danish", "/home/all_wavs/")]
    routed = [value(spark, lambda c: fn.route_paths(c, rules), c=p) for p in ("/x/common_voice/a.wav", "/nst_danish/b.wav", "/c.wav")]
    assert routed == ["/home/wavs/a.wav", "/home/all_wavs/b.wav", "/c.wav"]
    kept = [value(spark, lambda c: fn.name_parts_ne(c, 2), c=n) for n in ("A.TextGrid", "A_B.TextGrid", "A_B_C.TextGrid")]
    assert kept == [True, False, True]


def test_segment_names_round_trip(spark):
    df = spark.createDataFrame([("A_B_C", 0.2, 2.456), ("x", 2.0, 12345678.5), ("y", 0.004, 3.999)], "b string, s double, e double")
    named = df.select("s", "e", fn.encode_segment(F.col("b"), F.col("s"), F.col("e")).alias("n"))
    got = named.select("n", fn.decode_segment(F.col("n")).alias("d"), fn.py_round(F.col("s"), 2), fn.py_round(F.col("e"), 2)).collect()
    assert [r.n for r in got] == ["A_B_C_0000_0.2_2.46.wav", "x_0000_2.0_12345678.5.wav", "y_0000_0.0_4.0.wav"]
    assert all((r.d.start_time, r.d.end_time) == (r[2], r[3]) for r in got)
    assert [r.d.source for r in got] == ["A_B_C.wav", "x.wav", "y.wav"]
    assert value(spark, lambda c: fn.decode_segment(c), c="plain.wav").source is None


def test_natural_order(spark):
    names = ["checkpoint-1000", "checkpoint-200", "checkpoint-30", "10a", "9b", "a!", "a1b", "ab"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    import re

    want = sorted(names, key=lambda s: [int(c) if c.isdigit() else c for c in re.split("([0-9]+)", s)])
    assert [r.n for r in df.orderBy(fn.natural_key(F.col("n"))).collect()] == want


def test_cleaning(spark):
    assert value(spark, lambda c: fn.strip_punct(c), c="你好，café-a！：b。\n") == "你好cafeab"
    assert value(spark, lambda c: fn.cut_at(c), c="今天很好（笑）") == "今天很好"
    assert value(spark, lambda c: fn.space_scripts(c), c="中文USD交易spot") == "中文 USD 交易 spot"
    assert value(spark, lambda c: fn.space_scripts(c), c="<p>汉a字</p>") == "汉 a 字"
    assert value(spark, lambda c: fn.normalize_basic(c), c="Hello, [noise] (um) WORLD! ＡＢ　Ⅸ") == "hello world ab ⅸ".replace("ⅸ", "ⅸ")
    assert value(spark, lambda c: fn.normalize_basic(c, full_nfkc=True), c="㎏ ﬁ") == "kg fi"
    assert value(spark, lambda c: fn.strip_tags(c), c="<p>a&amp;b</p><script>x<y</script> c") == "a&b c"
    assert value(spark, lambda c: fn.sentences(c), c="One. Two!\nthree 3。 ...") == ["One.", "Two!", "three 3。"]


def test_tokens(spark):
    assert value(spark, lambda c: fn.tokenize_mixed(c), c="买 USD 100，ok 吗") == ["买", "usd", "1", "0", "0", "ok", "吗"]
    assert value(spark, lambda c: fn.tokenize_mixed(c), c="买USD 100，ok吗") == ["买", "usd", "1", "0", "0", "ok吗"]
    assert value(spark, lambda c: fn.tokenize_mixed(c), c="Ｕsd1 don't x") == ["usd1", "don", "t", "x"]
    assert value(spark, lambda c: fn.tokenize_mixed(c), c=" ，") == []
    assert value(spark, lambda c: fn.loan_tokens(fn.tokenize_mixed(c)), c="买 USD 1 ok吗") == ["usd", "ok吗"]


def test_special_characters(spark):
    df = spark.createDataFrame([("a:b",), ("你好",), ("don't",), ("don’t",), ("x-y",), ("w≈",)], "t string")
    got = {r.t for r in df.filter(fn.has_any_char(F.col("t"))).collect()}
    assert got == {"a:b", "don’t", "w≈"}


def test_script(spark):
    from voxloom.operators.script_rows import convert_script

    table = [("汉", "漢"), ("语", "語")]
    df = spark.createDataFrame([("汉语abc",), ("漢語",), ("中",), ("abc",)], "text string")
    want = [("abc", False), ("中", True), ("漢語", False), ("漢語abc", True)]
    assert rows(convert_script(df, "text", table), "text", "converted") == want
    frame = spark.createDataFrame(table, "simplified string, traditional string")
    assert rows(convert_script(df, "text", frame), "text", "converted") == want
