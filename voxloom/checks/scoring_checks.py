"""Pairing, alignment, error rates, loan words and checkpoint ranking, on whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import combine, loanwords, scoring
from ..operators.alignment import align, confusions, word_distance
from ..operators.filters import below_rate
from ..session import spread
from ..plans import checkpoint_report, sanity_check, score_checkpoints
from ..sources import parse_sanity_lines, write_averages, write_sanity_report, write_score_report
from . import views as v
from .registry import check
from .text_checks import clean_sql, normal_sql, spaced_sql, tokens_sql

RP = v.with_views(v.REFS, v.PREDICTIONS)
SCORING = lambda c: tokens_sql(spaced_sql(clean_sql(c)))
PLAIN = lambda c: f"list_filter(string_split({normal_sql(c)}, ' '), lambda t: t <> '')"

# The edit table walked diagonal by diagonal. A cell is one number: cost, correct, substituted and
# inserted words in fields of 20, 14, 14 and 14 bits. Cell i of a diagonal is row i of the table.
WALK = """pairs AS ({pairs}),
walk AS (
  SELECT id, r, h, len(r) AS n, len(h) AS m, 0 AS d,
    list_concat([0::BIGINT], list_transform(range(0, len(r)), lambda x: NULL::BIGINT)) AS p1, CAST(NULL AS BIGINT[]) AS p2
  FROM pairs
  UNION ALL
  SELECT id, r, h, n, m, d + 1,
    list_transform(range(0, n + 1), lambda i: CASE
      WHEN d + 1 - i < 0 OR d + 1 - i > m THEN NULL
      WHEN i = 0 THEN (d + 1) * ((1::BIGINT << 42) + 1)
      WHEN i = d + 1 THEN i * (1::BIGINT << 42)
      WHEN r[i] = h[d + 1 - i] THEN p2[i] + (1::BIGINT << 28)
      WHEN (p2[i] >> 42) <= (p1[i + 1] >> 42) AND (p2[i] >> 42) <= (p1[i] >> 42) THEN p2[i] + (1::BIGINT << 42) + (1 << 14)
      WHEN (p1[i + 1] >> 42) <= (p1[i] >> 42) THEN p1[i + 1] + (1::BIGINT << 42) + 1
      ELSE p1[i] + (1::BIGINT << 42) END), p1
  FROM walk WHERE d < n + m),
counts AS (
  SELECT id, n, v >> 42 AS cost, (v >> 28) & 16383 AS cor, (v >> 14) & 16383 AS sub, v & 16383 AS ins,
    (v >> 42) - ((v >> 14) & 16383) - (v & 16383) AS del
  FROM (SELECT id, n, p1[n + 1] AS v FROM walk WHERE d = n + m))"""


def walk_sql(words) -> str:
    pairs = (
        "SELECT p.checkpoint || '|' || audio_filepath AS id, r.w AS r, p.w AS h "
        f"FROM (SELECT checkpoint, audio_filepath, {words('hyp')} AS w FROM predictions) p "
        f"JOIN (SELECT audio_filepath, {words('text')} AS w FROM refs) r USING (audio_filepath)"
    )
    return "WITH RECURSIVE " + ",\n".join([v.REFS, v.PREDICTIONS, WALK.format(pairs=pairs)]) + "\n"


# The walk back from the last cell: a list of the cell reached, then a number per move, of its kind and the cell it stops at.
# Costs are read from the diagonals; the order of preference is that of the walk there.
COST = "c[a[1] + a[2] + {dd}][a[1] + {di}]"
TRACE = f"""costs AS (SELECT id, list(list_transform(p1, lambda x: x >> 42) ORDER BY d) AS c FROM walk GROUP BY id),
ends AS (SELECT DISTINCT ON (id) id, r, h, n, m FROM walk WHERE d = 0),
traced AS (SELECT id, r, h, list_reduce(list_concat([[n, m]], list_transform(range(n + m), lambda x: [x])), lambda a, x: CASE
    WHEN a[1] = 0 AND a[2] = 0 THEN a
    WHEN a[1] > 0 AND a[2] > 0 AND r[a[1]] = h[a[2]] THEN list_concat([a[1] - 1, a[2] - 1], a[3:], [(a[1] - 1) * 1048576 + a[2] - 1])
    WHEN a[1] > 0 AND a[2] > 0 AND {COST.format(dd=-1, di=0)} <= {COST.format(dd=0, di=1)} AND {COST.format(dd=-1, di=0)} <= {COST.format(dd=0, di=0)}
      THEN list_concat([a[1] - 1, a[2] - 1], a[3:], [1099511627776 + (a[1] - 1) * 1048576 + a[2] - 1])
    WHEN a[2] > 0 AND (a[1] = 0 OR {COST.format(dd=0, di=1)} <= {COST.format(dd=0, di=0)})
      THEN list_concat([a[1], a[2] - 1], a[3:], [2 * 1099511627776 + a[1] * 1048576 + a[2] - 1])
    ELSE list_concat([a[1] - 1, a[2]], a[3:], [3 * 1099511627776 + (a[1] - 1) * 1048576 + a[2]]) END)[3:] AS moves FROM ends JOIN costs USING (id)),
steps AS (SELECT id, r, h, (x >> 40)::INTEGER AS kind, (x >> 20) & 1048575 AS i, x & 1048575 AS j FROM (SELECT id, r, h, unnest(moves) AS x FROM traced)),
ops AS (SELECT id, i, j, ['OK', 'SUB', 'INS', 'DEL'][kind + 1] AS op, CASE WHEN kind <> 2 THEN r[i + 1] END AS ref, CASE WHEN kind <> 3 THEN h[j + 1] END AS hyp FROM steps)"""


ID = "split_part(id, '|', 1) AS checkpoint, split_part(id, '|', 2) AS audio_filepath"
PERCENT = "avg({c} / n::DOUBLE * 100)"
MACRO_SQL = """macro AS (SELECT split_part(id, '|', 1) AS checkpoint, count(*) AS n_files, avg(cor / n::DOUBLE * 100) AS avg_cor,
    avg(format('{:.3f}', cost / n::DOUBLE)::DOUBLE * 100) AS avg_wer, avg(ins / n::DOUBLE * 100) AS avg_ins,
    avg(sub / n::DOUBLE * 100) AS avg_sub, avg(del / n::DOUBLE * 100) AS avg_del FROM counts WHERE n > 0 GROUP BY 1)"""


def pairs(spark, d):
    return scoring.pair(v.refs(spark, d), v.predictions(spark, d))


def worded(spark, d, words):
    # A reference is cut into words once, not for each checkpoint; joined by blanks, which no word holds, they move as text.
    cut = v.refs(spark, d).withColumn("text", F.array_join(words(F.col("text")), " "))
    return spread(scoring.pair(cut, v.predictions(spark, d))).select(
        "checkpoint", "audio_filepath", F.filter(F.split("ref", " "), lambda w: w != "").alias("ref_words"), words(F.col("hyp")).alias("hyp_words")
    )


@check("d4_pair", RP + "SELECT checkpoint, audio_filepath, role, md5(text) AS ref_md5, md5(hyp) AS hyp_md5 FROM predictions JOIN refs USING (audio_filepath)")
def d4(spark, d):
    return pairs(spark, d).select("checkpoint", "audio_filepath", "role", F.md5("ref").alias("ref_md5"), F.md5("hyp").alias("hyp_md5"))


@check(
    "d6_pending_work",
    RP + """SELECT c.checkpoint, r.audio_filepath FROM refs r, (SELECT DISTINCT checkpoint FROM predictions) c
    WHERE NOT EXISTS (SELECT 1 FROM predictions p JOIN refs q USING (audio_filepath)
      WHERE p.checkpoint = c.checkpoint AND p.audio_filepath = r.audio_filepath AND (q.role = 'user' OR p.checkpoint = 'checkpoint-30'))""",
)
def d6(spark, d):
    done = pairs(spark, d).filter("role = 'user' OR checkpoint = 'checkpoint-30'")
    return scoring.pending_work(v.CHECKPOINTS, v.refs(spark, d), done)


@check("t15_word_alignment", walk_sql(SCORING) + f"SELECT {ID}, cor::INTEGER AS cor, sub::INTEGER AS sub, ins::INTEGER AS ins, del::INTEGER AS del, n::INTEGER AS ref_len FROM counts")
def t15(spark, d):
    return align(worded(spark, d, scoring.scoring_words)).drop("ref_words", "hyp_words")


@check(
    "t16_rates",
    walk_sql(SCORING) + f"""SELECT {ID}, format('{{:.3f}}', cost / n::DOUBLE)::DOUBLE AS wer3, round(cor / n::DOUBLE * 100, 6) AS cor_pct,
      round(sub / n::DOUBLE * 100, 6) AS sub_pct, round(ins / n::DOUBLE * 100, 6) AS ins_pct, round(del / n::DOUBLE * 100, 6) AS del_pct FROM counts WHERE n > 0""",
)
def t16(spark, d):
    scored = score_checkpoints(v.refs(spark, d), v.predictions(spark, d)).filter("reason IS NULL")
    return scored.select(
        "checkpoint", "audio_filepath", F.round(F.col("wer") / 100, 3).alias("wer3"),
        *[F.round(c, 6).alias(c) for c in ("cor_pct", "sub_pct", "ins_pct", "del_pct")],
    )


@check("t15_word_distance", walk_sql(SCORING) + f"SELECT {ID}, cost::INTEGER AS distance FROM counts")
def t15b(spark, d):
    rows = worded(spark, d, scoring.scoring_words)
    return rows.select("checkpoint", "audio_filepath", word_distance(F.col("ref_words"), F.col("hyp_words")).alias("distance"))


@check("t18_confusion_totals", walk_sql(SCORING) + "SELECT op, n::BIGINT AS n FROM (SELECT unnest(['OK', 'SUB', 'INS', 'DEL']) AS op, unnest([sum(cor), sum(sub), sum(ins), sum(del)]) AS n FROM counts)")
def t18(spark, d):
    return confusions(worded(spark, d, scoring.scoring_words)).groupBy("op").agg(F.sum("n").alias("n"))


@check(
    "t18_confusions",
    walk_sql(SCORING).rstrip() + ",\n" + TRACE + " SELECT op, ref, hyp, count(*)::BIGINT AS n FROM ops GROUP BY 1, 2, 3 ORDER BY n DESC, op, ref NULLS FIRST, hyp NULLS FIRST LIMIT 500",
)
def t18b(spark, d):
    return confusions(worded(spark, d, scoring.scoring_words), k=500)


# Letters outside ASCII become unused control characters, because this levenshtein counts bytes.
NARROW = "translate({c}, 'éèêçäöüßñíóÉÈÊÇÄÖÜÑÍÓ', " + " || ".join(f"chr({k})" for k in [*range(1, 9), *range(14, 27)]) + ")"


@check(
    "t17_cer",
    RP + f"""SELECT checkpoint, audio_filepath, round(levenshtein({NARROW.format(c='text')}, {NARROW.format(c='hyp')}) / length(text)::DOUBLE, 6) AS cer
    FROM predictions JOIN refs USING (audio_filepath)""",
)
def t17(spark, d):
    return scoring.pair_cer(pairs(spark, d)).select("checkpoint", "audio_filepath", F.round("cer", 6).alias("cer"))


@check(
    "e8_micro_cer",
    RP + f"""SELECT checkpoint, round(sum(levenshtein({NARROW.format(c='text')}, {NARROW.format(c='hyp')})) / sum(length(text))::DOUBLE, 6) AS cer
    FROM predictions JOIN refs USING (audio_filepath) GROUP BY 1""",
)
def e8(spark, d):
    return scoring.micro_cer(pairs(spark, d)).select("checkpoint", F.round("cer", 6).alias("cer"))


AVERAGES = ("avg_cor", "avg_wer", "avg_ins", "avg_sub", "avg_del")


@check(
    "e7_macro_scores",
    walk_sql(SCORING).rstrip() + ",\n" + MACRO_SQL + f" SELECT checkpoint, n_files::BIGINT AS n_files, {', '.join(f'round({c}, 6) AS {c}' for c in AVERAGES)} FROM macro",
)
def e7(spark, d):
    macro = scoring.macro_scores(score_checkpoints(v.refs(spark, d), v.predictions(spark, d)))
    return macro.select("checkpoint", "n_files", *[F.round(c, 6).alias(c) for c in AVERAGES])


@check(
    "e12_best_checkpoint",
    walk_sql(SCORING).rstrip() + ",\n" + MACRO_SQL + """ SELECT arg_max(checkpoint, avg_cor) AS best_by_cor, arg_min(checkpoint, avg_wer) AS best_by_wer FROM macro""",
)
def e12(spark, d):
    return scoring.best_checkpoint(scoring.macro_scores(score_checkpoints(v.refs(spark, d), v.predictions(spark, d))))


@check(
    "b2_score_report",
    walk_sql(SCORING) + """SELECT checkpoint, audio_filepath || '  |  WER: ' || format('{:.2f}', format('{:.3f}', cost / n::DOUBLE)::DOUBLE * 100) || '  |  COR: ' || format('{:.2f}', cor / n::DOUBLE * 100)
      || '  |  DEL: ' || format('{:.2f}', del / n::DOUBLE * 100) || '  |  SUB: ' || format('{:.2f}', sub / n::DOUBLE * 100) || '  |  INS: ' || format('{:.2f}', ins / n::DOUBLE * 100) AS line
    FROM (SELECT *, """ + ID + """ FROM counts WHERE n > 0)""",
)
def b2(spark, d):
    path = v.scratch(spark)
    write_score_report(score_checkpoints(v.refs(spark, d), v.predictions(spark, d)).filter("reason IS NULL"), path)
    return spark.read.schema("line string, checkpoint string").text(f"{path}/text").select("checkpoint", "line")


@check(
    "b2_sanity_report",
    walk_sql(PLAIN) + f"""SELECT split_part(id, '|', 1) AS checkpoint, split_part(id, '|', 2) AS audio_filepath, round(cost / n::DOUBLE, 9) AS rate,
      md5(trim({normal_sql('refs.text')})) AS ref_md5, md5(trim({normal_sql('predictions.hyp')})) AS hyp_md5
    FROM counts JOIN refs ON refs.audio_filepath = split_part(id, '|', 2)
      JOIN predictions ON predictions.audio_filepath = refs.audio_filepath AND predictions.checkpoint = split_part(id, '|', 1)
    WHERE cost / n::DOUBLE < 0.15 AND length(trim({normal_sql('refs.text')})) > 1""",
)
def b2b(spark, d):
    """The report of accepted rows, read back by the parser of such reports."""
    path = v.scratch(spark)
    named = pairs(spark, d).withColumn("audio_filepath", F.concat_ws("|", "checkpoint", "audio_filepath"))
    write_sanity_report(sanity_check(named, 0.15).scored, path, 0.15)
    parsed = parse_sanity_lines(spark.read.text(f"{path}/accepted")).kept
    place = F.split("audio_filepath", r"\|")
    return parsed.select(
        place[0].alias("checkpoint"), place[1].alias("audio_filepath"), F.round("rate", 9).alias("rate"), F.md5("ref").alias("ref_md5"), F.md5("hyp").alias("hyp_md5")
    )


@check(
    "b2_averages",
    walk_sql(SCORING).rstrip() + ",\n" + MACRO_SQL + """ SELECT checkpoint, checkpoint || '  |  AVERAGE COR: ' || format('{:.2f}', avg_cor) || '  |  AVERAGE WER: ' || format('{:.2f}', avg_wer)
      || '  |  AVERAGE INS: ' || format('{:.2f}', avg_ins) || '  |  AVERAGE SUB: ' || format('{:.2f}', avg_sub) || '  |  AVERAGE DEL: ' || format('{:.2f}', avg_del) AS line FROM macro""",
)
def b2c(spark, d):
    path = v.scratch(spark)
    write_averages(scoring.macro_scores(score_checkpoints(v.refs(spark, d), v.predictions(spark, d))), path)
    return spark.read.schema("line string, checkpoint string").text(path).select("checkpoint", "line")


@check(
    "e12_best_by_cer",
    RP + f"""SELECT arg_min(checkpoint, cer) AS best_by_cer FROM (SELECT checkpoint, sum(levenshtein({NARROW.format(c='text')}, {NARROW.format(c='hyp')})) / sum(length(text))::DOUBLE AS cer
    FROM predictions JOIN refs USING (audio_filepath) GROUP BY 1)""",
)
def e12b(spark, d):
    cer = scoring.micro_cer(pairs(spark, d))
    return scoring.best_checkpoint(cer, cor=None, wer=None, cer="cer")


LOAN = f"""g AS (SELECT word, count(*) AS g FROM (SELECT unnest({SCORING('text')}) AS word FROM refs) WHERE regexp_matches(word, '[a-z]') GROUP BY 1),
p AS (SELECT checkpoint, word, count(*) AS p FROM (SELECT checkpoint, unnest({SCORING('hyp')}) AS word FROM predictions) WHERE regexp_matches(word, '[a-z]') GROUP BY 1, 2)"""
LOAN_SCORES = """SELECT c.checkpoint, (SELECT coalesce(sum(p), 0) FROM p WHERE p.checkpoint = c.checkpoint AND word IN (SELECT word FROM g))::BIGINT AS tp,
  (SELECT coalesce(sum(p), 0) FROM p WHERE p.checkpoint = c.checkpoint AND word NOT IN (SELECT word FROM g))::BIGINT AS fp,
  (SELECT sum(greatest(g.g - coalesce(q.p, 0), 0)) FROM g LEFT JOIN (SELECT * FROM p WHERE p.checkpoint = c.checkpoint) q USING (word))::BIGINT AS fn
FROM (SELECT 'checkpoint-30' AS checkpoint UNION ALL SELECT 'checkpoint-200' UNION ALL SELECT 'checkpoint-1000' UNION ALL SELECT 'checkpoint-2000') c"""


def truth_words(spark, d):
    return loanwords.loan_words(v.refs(spark, d).select(scoring.scoring_words(F.col("text")).alias("ref_words")))


def heard_words(spark, d):
    heard = v.predictions(spark, d).select("checkpoint", scoring.scoring_words(F.col("hyp")).alias("hyp_words"))
    return loanwords.loan_words(heard, "hyp_words", ["checkpoint"])


@check("e9_loan_word_scores", RP.rstrip() + ",\n" + LOAN + LOAN_SCORES.replace("SELECT c.", " SELECT c.", 1))
def e9(spark, d):
    return loanwords.loan_word_scores(truth_words(spark, d), heard_words(spark, d))


KEYS = ["the", "und", "tion", "ver", "la"]


@check(
    "x8_keyword_rate",
    RP.rstrip() + ",\n" + LOAN.replace("'[a-z]') GROUP", "'[a-z]') AND word IN ('the', 'und', 'tion', 'ver', 'la') GROUP") + LOAN_SCORES.replace("SELECT c.", " SELECT c.", 1),
)
def x8(spark, d):
    return loanwords.loan_word_scores(truth_words(spark, d), heard_words(spark, d), only=KEYS)


@check(
    "d5_loan_word_pairs",
    RP.rstrip() + ",\n" + LOAN + """ SELECT c.checkpoint, word, coalesce(g, 0)::BIGINT AS in_truth, coalesce(p, 0)::BIGINT AS heard
    FROM (SELECT DISTINCT checkpoint FROM p) c, (SELECT word FROM g UNION SELECT word FROM p) w LEFT JOIN g USING (word)
      LEFT JOIN p ON p.word = w.word AND p.checkpoint = c.checkpoint WHERE g IS NOT NULL OR p IS NOT NULL""",
)
def d5(spark, d):
    """Every checkpoint against the truth."""
    return loanwords.loan_word_pairs(truth_words(spark, d), heard_words(spark, d), "checkpoint", v.CHECKPOINTS)


@check(
    "e13_loan_word_totals",
    RP.rstrip() + ",\n" + LOAN + " SELECT checkpoint, sum(p)::BIGINT AS n_words FROM p GROUP BY 1 UNION ALL SELECT 'truth', sum(g)::BIGINT FROM g",
)
def e13(spark, d):
    truth = loanwords.loan_word_totals(truth_words(spark, d)).select(F.lit("truth").alias("checkpoint"), "n_words")
    return loanwords.loan_word_totals(heard_words(spark, d), ["checkpoint"]).unionByName(truth)


@check(
    "c7_sanity_check",
    walk_sql(PLAIN) + f"SELECT {ID}, round(cost / n::DOUBLE, 9) AS error FROM counts JOIN refs ON audio_filepath = split_part(id, '|', 2) WHERE cost / n::DOUBLE < 0.15 AND length(trim({normal_sql('text')})) > 1",
)
def c7(spark, d):
    named = pairs(spark, d).withColumn("audio_filepath", F.concat_ws("|", "checkpoint", "audio_filepath"))
    accepted = sanity_check(named, 0.15).accepted
    place = F.split("audio_filepath", r"\|")
    return accepted.select(place[0].alias("checkpoint"), place[1].alias("audio_filepath"), F.round("error", 9).alias("error"))


@check(
    "c7_cer_threshold",
    RP + f"""SELECT checkpoint, audio_filepath FROM predictions JOIN refs USING (audio_filepath)
    WHERE levenshtein({NARROW.format(c='text')}, {NARROW.format(c='hyp')}) / length(text)::DOUBLE < 0.05""",
)
def c7b(spark, d):
    return below_rate(scoring.pair_cer(pairs(spark, d), below=0.05), "cer", 0.05).kept.select("checkpoint", "audio_filepath")


@check(
    "p2_checkpoint_report",
    walk_sql(SCORING).rstrip() + ",\n" + MACRO_SQL + ",\n" + LOAN + ",\nls AS (" + LOAN_SCORES + f""")
    SELECT checkpoint, n_files::BIGINT AS n_files, {', '.join(f'round({c}, 6) AS {c}' for c in AVERAGES)}, tp, fp, fn,
      checkpoint = (SELECT arg_max(checkpoint, avg_cor) FROM macro) AS is_best_cor, checkpoint = (SELECT arg_min(checkpoint, avg_wer) FROM macro) AS is_best_wer
    FROM macro JOIN ls USING (checkpoint)""",
)
def p2(spark, d):
    report = checkpoint_report(v.refs(spark, d), v.predictions(spark, d))
    return report.withColumns({c: F.round(c, 6) for c in AVERAGES})


TIMED_PAIRS = """SELECT audio_filepath AS id, r, h FROM (SELECT audio_filepath, list_filter(regexp_split_to_array(regexp_replace(text, ' [a-z]{2} ', ' in ', 'g'), '\\s+'), lambda t: t <> '') AS r FROM refs)
  JOIN (SELECT audio_filepath, list(word ORDER BY start, "end", pos, word) AS h FROM timed_words GROUP BY 1) USING (audio_filepath)"""


@check(
    "x9_word_times",
    "WITH RECURSIVE " + ",\n".join([v.REFS, v.TIMED_WORDS, WALK.replace("{pairs}", TIMED_PAIRS), TRACE])
    + """, slots AS (SELECT audio_filepath AS id, start, "end", row_number() OVER (PARTITION BY audio_filepath ORDER BY start, "end", pos, word) - 1 AS j FROM timed_words)
    SELECT o.id AS audio_filepath, o.i::INTEGER AS pos, o.ref AS word, o.op, s.start, s."end" FROM ops o
      LEFT JOIN slots s ON s.id = o.id AND s.j = o.j AND o.op <> 'DEL' WHERE o.op <> 'INS'""",
)
def x9(spark, d):
    truth = v.refs(spark, d).select("audio_filepath", F.regexp_replace("text", " [a-z]{2} ", " in ").alias("text"))
    return combine.word_times(truth, v.timed_words(spark, d))


@check(
    "b2_report_lines",
    walk_sql(SCORING).rstrip() + ",\n" + MACRO_SQL + ",\n" + LOAN + ",\nls AS (" + LOAN_SCORES + """)
    SELECT checkpoint, checkpoint || '  |  AVERAGE COR: ' || format('{:.2f}', avg_cor) || '  |  AVERAGE WER: ' || format('{:.2f}', avg_wer)
      || '  |  AVERAGE INS: ' || format('{:.2f}', avg_ins) || '  |  AVERAGE SUB: ' || format('{:.2f}', avg_sub) || '  |  AVERAGE DEL: ' || format('{:.2f}', avg_del)
      || '  |  LOAN WORDS TP: ' || tp || '  |  LOAN WORDS FP: ' || fp || '  |  LOAN WORDS FN: ' || fn AS line FROM macro JOIN ls USING (checkpoint)""",
)
def b2_report(spark, d):
    """The lines of the whole report, loan words included."""
    path = v.scratch(spark)
    write_averages(checkpoint_report(v.refs(spark, d), v.predictions(spark, d)), path)
    return spark.read.schema("line string, checkpoint string").text(path).select("checkpoint", "line")
