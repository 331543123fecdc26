"""Scalar functions on names and texts, keyword search, sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    base_name,
    bracket_id,
    cut_at,
    decode_segment,
    encode_segment,
    loan_tokens,
    natural_key,
    normalize_basic,
    py_round,
    safe_int,
    space_scripts,
    strip_punct,
    swap_ext,
    tokenize_mixed,
)
from ..operators import dedupe, keywords, sentences
from ..session import spread
from ..operators.segmentation import segment_latin, word_counts, word_pair_counts
from . import views as v
from .registry import check

M = v.with_views(v.MANIFEST)
BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"
MARKS = r"[\p{M}\p{S}\p{P}]"


def clean_sql(c: str) -> str:
    return f"translate({c}, 'é。：,，！-' || chr(10), 'e')"


def spaced_sql(c: str) -> str:
    return (
        rf"regexp_replace(regexp_replace({c}, '(\p{{Han}})([A-Za-z0-9])', '\1 \2', 'g'), '([A-Za-z0-9])(\p{{Han}})', '\1 \2', 'g')"
    )


def tokens_sql(c: str) -> str:
    spread = rf"regexp_replace(regexp_replace(lower({c}), '{MARKS}', ' ', 'g'), '([^a-z])', '\1 ', 'g')"
    return f"list_filter(string_split_regex({spread}, '{BLANK}+'), lambda t: t <> '')"


def normal_sql(c: str) -> str:
    x = rf"regexp_replace(regexp_replace(lower({c}), '[<\[][^>\]]*[>\]]', '', 'g'), '\(([^)]+?)\)', '', 'g')"
    return f"regexp_replace(lower(regexp_replace({x}, '{MARKS}', ' ', 'g')), '{BLANK}+', ' ', 'g')"


@check("t1_base_name", "SELECT page_id, string_split(url, '/')[-1] AS name FROM pages")
def t1(spark, d):
    return v.table(spark, d, "pages").select("page_id", base_name(F.col("url")).alias("name"))


@check("t2_swap_ext", "SELECT page_id, string_split(url, '.example')[1] || '.wav' AS name FROM pages")
def t2(spark, d):
    return v.table(spark, d, "pages").select("page_id", swap_ext(F.col("url"), ".example", ".wav").alias("name"))


@check("t3_bracket_id", M + r"SELECT row_id, nullif(regexp_extract(audio_filepath, '\[([^\[\]]+)\]\.wav$', 1), '') AS id FROM manifest")
def t3(spark, d):
    return v.manifest(spark, d).select("row_id", bracket_id(F.col("audio_filepath")).alias("id"))


@check(
    "t3_rename_plan",
    """SELECT source, target, claims > 1 AS collision FROM (
      SELECT '/yt/' || lang || ' ' || doc_id || ' [' || (n_chars % 300) || '].wav' AS source, '/yt/' || (n_chars % 300) || '.wav' AS target,
        count(*) OVER (PARTITION BY n_chars % 300) AS claims FROM documents)""",
)
def t3_plan(spark, d):
    path = F.concat(F.lit("/yt/"), "lang", F.lit(" "), "doc_id", F.lit(" ["), F.col("n_chars") % 300, F.lit("].wav"))
    return dedupe.rename_plan(v.table(spark, d, "documents").select(path.alias("path")))


@check(
    "t4_t5_segment_names",
    v.with_views(v.SEGMENTS)
    + r"""SELECT base || '_0000_' || regexp_replace(format('{:.2f}', lo), '(\.\d)0$', '\1') || '_' || regexp_replace(format('{:.2f}', hi), '(\.\d)0$', '\1') || '.wav' AS name,
      base || '.wav' AS source, format('{:.2f}', lo)::DOUBLE AS start_time, format('{:.2f}', hi)::DOUBLE AS end_time FROM segments""",
)
def t5(spark, d):
    named = v.segments(spark, d).select(encode_segment(F.col("base"), F.col("lo"), F.col("hi")).alias("name"))
    return named.select("name", decode_segment(F.col("name")).alias("s")).select("name", "s.*")


@check("t6_cut_bracket", v.with_views(v.MIXED) + "SELECT doc_id, md5(split_part(text, '（', 1)) AS text_md5 FROM mixed")
def t6(spark, d):
    return v.mixed(spark, d).select("doc_id", F.md5(cut_at(F.col("text"))).alias("text_md5"))


@check("t7_strip_punctuation", v.with_views(v.MIXED) + f"SELECT doc_id, md5({clean_sql('text')}) AS text_md5 FROM mixed")
def t7(spark, d):
    return v.mixed(spark, d).select("doc_id", F.md5(strip_punct(F.col("text"))).alias("text_md5"))


@check("t8_space_scripts", v.with_views(v.MIXED) + f"SELECT doc_id, md5({spaced_sql('text')}) AS text_md5 FROM mixed")
def t8(spark, d):
    return v.mixed(spark, d).select("doc_id", F.md5(space_scripts(F.col("text"))).alias("text_md5"))


@check(
    "t9_tokenize_mixed",
    v.with_views(v.MIXED) + f"SELECT doc_id, len(t)::INTEGER AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM mixed)",
)
def t9(spark, d):
    rows = v.mixed(spark, d).select("doc_id", tokenize_mixed(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@check("t10_normalize", v.with_views(v.MIXED) + f"SELECT doc_id, md5({normal_sql('text')}) AS text_md5 FROM mixed WHERE lang <> 'none'")
def t10(spark, d):
    return v.mixed(spark, d).select("doc_id", F.md5(normalize_basic(F.col("text"))).alias("text_md5"))


@check("t11_segment_latin")
def t11(spark, d):
    docs = v.table(spark, d, "documents")
    runs = v.mixed(spark, d).select("doc_id", "text")
    return segment_latin(runs, word_counts(docs), word_pair_counts(docs), key="doc_id").select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


@check(
    "t12_c10_script",
    v.with_views(v.MIXED)
    + r"""SELECT doc_id, converted, md5(CASE WHEN converted THEN translate(text, '汉语国', '漢語國') ELSE text END) AS text_md5
    FROM (SELECT doc_id, text, regexp_matches(text, '\p{Han}') AND NOT regexp_matches(text, '[漢語國]') AS converted FROM mixed)""",
)
def t12(spark, d):
    from ..operators.script_rows import convert_script

    rows = convert_script(v.mixed(spark, d), "text", v.SCRIPT_TABLE)
    return rows.select("doc_id", "converted", F.md5("text").alias("text_md5"))


# Phrases over the characters of ``mixed`` texts; some overlap, some begin others.
PHRASES = [("汉", "漢"), ("语", "語"), ("汉语", "漢語文"), ("语汉", "言"), ("汉 ", "漢_"), ("汉 的语", "三"), ("e汉", "E漢"), ("汉e", "佚e"), ("汉语e", "長的詞")]
_LONGEST = "|".join(w for w, _ in sorted(PHRASES, key=lambda p: -len(p[0])))


@check(
    "t12_phrases",
    v.with_views(v.MIXED)
    + rf"""SELECT doc_id, converted, md5(CASE WHEN converted THEN array_to_string(list_transform(regexp_extract_all(text, '(?s){_LONGEST}|.'),
        lambda t: CASE t {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in PHRASES)} ELSE t END), '') ELSE text END) AS text_md5
    FROM (SELECT doc_id, text, regexp_matches(text, '\p{{Han}}') AND NOT regexp_matches(text, '[漢語文言三佚長詞E_]') AS converted FROM mixed)""",
)
def t12b(spark, d):
    from ..operators.script_rows import convert_phrases

    rows = convert_phrases(v.mixed(spark, d), "text", spark.createDataFrame(PHRASES, "simplified string, traditional string"), per=4)
    return rows.select("doc_id", "converted", F.md5("text").alias("text_md5"))


@check("t13_py_round", "SELECT l_orderkey, l_linenumber, format('{:.2f}', l_extendedprice * (1 - l_discount))::DOUBLE AS net2, format('{:.3f}', l_quantity / 16)::DOUBLE AS sixteenth3 FROM lineitem")
def t13(spark, d):
    return v.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        py_round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net2"),
        py_round(F.col("l_quantity") / 16, 3).alias("sixteenth3"),
    )


@check(
    "t14_loan_words",
    v.with_views(v.MIXED) + f"""SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest({tokens_sql('text')}) AS word FROM mixed) WHERE regexp_matches(word, '[a-z]') GROUP BY 1""",
)
def t14(spark, d):
    rows = v.mixed(spark, d).select(F.explode(loan_tokens(tokenize_mixed(F.col("text")))).alias("word"))
    return rows.groupBy("word").agg(F.count("*").alias("n"))


@check("t19_json_lines", v.with_views(v.SEGMENTS) + """SELECT conv_id, turn, '{"audio_filepath":"' || base || '","duration":' || hi || ',"text":"' || replace(replace(replace(text, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n') || '"}' AS line FROM segments""".replace("\\\\", "\\"))
def t19(spark, d):
    rows = v.segments(spark, d)
    record = F.struct(F.col("base").alias("audio_filepath"), F.lit(None).cast("double").alias("start_time"), F.col("hi").alias("duration"), "text")
    return rows.select("conv_id", "turn", F.to_json(record).alias("line"))


@check("t20_lower_trim", "SELECT doc_id, md5(trim(lower(text))) AS text_md5 FROM documents")
def t20(spark, d):
    return v.table(spark, d, "documents").select("doc_id", F.md5(F.trim(F.lower("text"))).alias("text_md5"))


@check("t22_safe_int", "SELECT page_id, TRY_CAST(regexp_extract(url, '([^/]*)$', 1) AS BIGINT) AS number FROM pages")
def t22(spark, d):
    return v.table(spark, d, "pages").select("page_id", safe_int(base_name(F.col("url"))).alias("number"))


@check(
    "g1_natural_order",
    r"""WITH k AS (SELECT page_id, list_transform(regexp_extract_all(url, '[0-9]+|[^0-9]+'), lambda x:
      CASE WHEN regexp_matches(x, '^[0-9]') THEN {'t': '', 'n': length(regexp_replace(x, '^0+', '')), 'd': regexp_replace(x, '^0+', '')}
      ELSE {'t': x, 'n': 0, 'd': ''} END) AS k FROM pages)
    SELECT page_id, array_to_string(list_transform(k, lambda p: p.t || CASE WHEN p.t = '' THEN p.n || ':' || p.d ELSE '' END), '~') AS sort_key FROM k""",
)
def g1(spark, d):
    rows = v.table(spark, d, "pages").select("page_id", natural_key(F.col("url")).alias("k"))
    shown = F.transform("k", lambda p: F.concat(p["text"], F.when(p["text"] == "", F.concat_ws(":", p["size"], p["digits"])).otherwise("")))
    return rows.orderBy("k").select("page_id", F.array_join(shown, "~").alias("sort_key"))


KEYWORDS = ["tion", "keit", "eaux", "zzzz", " the ", "ver"]
KEYWORDS_SQL = "kw AS (SELECT unnest(['tion', 'keit', 'eaux', 'zzzz', ' the ', 'ver']) AS keyword, unnest(range(6))::INTEGER AS kw_ord)"


@check("c9_keyword_contains", f"WITH {KEYWORDS_SQL} SELECT doc_id, keyword FROM documents, kw WHERE keyword = 'eaux' AND contains(text, keyword)")
def c9(spark, d):
    return keywords.keyword_matches(v.table(spark, d, "documents"), ["eaux"]).select("doc_id", "keyword")


@check("d3_keyword_join", f"WITH {KEYWORDS_SQL} SELECT doc_id, kw_ord, keyword FROM documents, kw WHERE contains(text, keyword)")
def d3(spark, d):
    return keywords.keyword_matches(v.table(spark, d, "documents"), KEYWORDS).select("doc_id", "kw_ord", "keyword")


@check(
    "d3_long_keyword_list",
    """WITH kw AS (SELECT DISTINCT item AS keyword FROM (SELECT unnest(string_split(text, ' ')) AS item FROM benchmark) WHERE item <> '')
    SELECT doc_id, count(*)::BIGINT AS n, md5(string_agg(keyword, ' ' ORDER BY keyword)) AS found_md5 FROM documents, kw WHERE contains(text, keyword) GROUP BY 1""",
)
def d3b(spark, d):
    words = v.table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("keyword")).filter("keyword <> ''")
    # Looking for thousands of words in a text costs far more than moving it.
    hits = keywords.keyword_table_matches(spread(v.table(spark, d, "documents")), words).groupBy("doc_id")
    found = F.array_join(F.array_sort(F.collect_list("keyword")), " ")
    return hits.agg(F.count("*").alias("n"), F.md5(found).alias("found_md5"))


@check(
    "f2_keyword_select",
    f"""WITH {KEYWORDS_SQL},
    hit AS (SELECT doc_id, text, kw_ord, keyword FROM documents, kw WHERE contains(text, keyword)
      QUALIFY row_number() OVER (PARTITION BY kw_ord ORDER BY doc_id) <= 100)
    SELECT doc_id, keyword FROM hit QUALIFY row_number() OVER (PARTITION BY text ORDER BY kw_ord, doc_id) = 1""",
)
def f2(spark, d):
    docs = v.table(spark, d, "documents").select("doc_id", "text")
    return keywords.select_by_keywords(docs, KEYWORDS, cap=100, order="doc_id").select("doc_id", "keyword")


TABLE_SQL = """kw AS (SELECT keyword, min(kw_ord) AS kw_ord FROM (SELECT unnest(w) AS keyword, item_id * 1000 + unnest(range(len(w))) AS kw_ord
      FROM (SELECT item_id, string_split(text, ' ') AS w FROM benchmark)) WHERE keyword <> '' GROUP BY keyword)"""


def keyword_table(spark, d):
    """The words of ``benchmark``, in order of their first place."""
    words = v.table(spark, d, "benchmark").select("item_id", F.posexplode(F.split("text", " ", -1)).alias("pos", "keyword")).filter("keyword <> ''")
    return words.select("keyword", (F.col("item_id") * 1000 + F.col("pos")).alias("kw_ord"))


@check(
    "f2_keyword_table",
    f"""WITH {TABLE_SQL},
    hit AS (SELECT doc_id, text, kw_ord, keyword FROM documents, kw WHERE contains(text, keyword)
      QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY doc_id) <= 7)
    SELECT doc_id, keyword, kw_ord FROM hit QUALIFY row_number() OVER (PARTITION BY text ORDER BY kw_ord, doc_id) = 1""",
)
def f2b(spark, d):
    docs = spread(v.table(spark, d, "documents").select("doc_id", "text"))
    return keywords.select_by_keyword_table(docs, keyword_table(spark, d), cap=7, order="doc_id", per=1000).select("doc_id", "keyword", "kw_ord")


@check(
    "e6_keyword_table",
    f"""WITH {TABLE_SQL} SELECT keyword, least(count(doc_id), 500)::BIGINT AS n, least(count(doc_id), 500) < 300 AS small
      FROM kw LEFT JOIN documents ON contains(text, keyword) GROUP BY keyword""",
)
def e6b(spark, d):
    return keywords.keyword_table_counts(spread(v.table(spark, d, "documents")), keyword_table(spark, d), cap=500)


@check(
    "e6_keyword_counts",
    f"""WITH {KEYWORDS_SQL} SELECT kw_ord, keyword, least(count(doc_id), 500)::BIGINT AS n, least(count(doc_id), 500) < 300 AS small
      FROM kw LEFT JOIN documents ON contains(text, keyword) GROUP BY kw_ord, keyword""",
)
def e6(spark, d):
    return keywords.keyword_counts(v.table(spark, d, "documents"), KEYWORDS, cap=500)


SENTENCES_SQL = r"""unnest(list_filter(list_transform(regexp_extract_all({c}, '[^.!?。！？\n]+[.!?。！？]*'), lambda s: trim(s)), lambda s: regexp_matches(s, '[^\s.!?。！？]')))"""


@check(
    "x1_keyword_sentences",
    f"""WITH s AS (SELECT doc_id, {SENTENCES_SQL.format(c='text')} AS sentence FROM documents), {KEYWORDS_SQL}
    SELECT doc_id, keyword, sentence FROM s, kw WHERE contains(sentence, keyword)""",
)
def x1(spark, d):
    return sentences.keyword_sentences(v.table(spark, d, "documents"), KEYWORDS, ["doc_id"]).select("doc_id", "keyword", "sentence")


@check(
    "x2_page_sentences",
    rf"""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g') AS x FROM pages),
    p AS (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g')) AS text FROM t),
    s AS (SELECT page_id, {SENTENCES_SQL.format(c='text')} AS sentence FROM p), {KEYWORDS_SQL}
    SELECT page_id, keyword, sentence FROM s, kw WHERE contains(sentence, keyword)""",
)
def x2(spark, d):
    return sentences.page_sentences(v.table(spark, d, "pages"), KEYWORDS, ["page_id"]).select("page_id", "keyword", "sentence")


@check(
    "x3_spoken_form",
    """SELECT doc_id FROM documents WHERE
      (length(text) - length(replace(text, 'the', ''))) // 3 + (length(text) - length(replace(text, 'ie', ''))) // 2
      >= (length(text) - length(replace(text, 'en', ''))) // 2 + (length(text) - length(replace(text, 'la', ''))) // 2""",
)
def x3(spark, d):
    return sentences.spoken_form(v.table(spark, d, "documents"), ["the", "ie"], ["en", "la"]).select("doc_id")


@check(
    "x7_scoring_cleanup",
    v.with_views(v.MIXED) + f"SELECT doc_id, md5({spaced_sql(clean_sql('text'))}) AS text_md5 FROM mixed",
)
def x7(spark, d):
    return v.mixed(spark, d).select("doc_id", F.md5(space_scripts(strip_punct(F.col("text")))).alias("text_md5"))
