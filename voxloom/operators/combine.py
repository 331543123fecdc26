"""New training rows out of existing ones: neighbours joined, overtalk, backchannel words, word times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import hash_rank, py_round, unit_hash
from ..functions.text import words
from ..session import spread
from .alignment import align_ops
from .filters import Split, first_reason, reason_if, split_by
from .ordering import dense_index


def join_neighbours(
    df: DataFrame, group: str = "source", order: str = "row_id", path: str = "audio_filepath", max_s: float = 30.0
) -> Split:
    """Rows 0+1, 2+3, … of each source as one longer row, where the sum of durations stays within ``max_s``.

    Pairs that are too long, or whose length is unknown, and the last row of an odd source are rejects.
    """
    numbered = dense_index(df.select(group, order, path, "duration", "text"), order, [group])
    first, second = F.col("idx") % 2 == 0, F.col("idx") % 2 == 1

    def side(test, c):
        return F.max(F.when(test, F.col(c)))

    joined = numbered.groupBy(group, F.floor(F.col("idx") / 2).alias("pair_no")).agg(
        side(first, path).alias("first_path"),
        side(second, path).alias("second_path"),
        (side(first, "duration") + side(second, "duration")).alias("duration"),
        F.concat_ws(" ", side(first, "text"), side(second, "text")).alias("text"),
        F.count(F.lit(1)).alias("_rows"),
    )
    reason = first_reason(
        F.when(F.col("_rows") == 1, F.lit("no_partner")), reason_if(~(F.col("duration") <= max_s), "long")
    )
    tagged = split_by(joined, reason)
    return Split(tagged.kept.drop("_rows"), tagged.rejects.drop("_rows"))


def files_of_words(timed: DataFrame) -> DataFrame:
    """Word rows (audio_filepath, pos, word, start, end) gathered per audio file, one file being one transcript."""
    return timed.groupBy("audio_filepath").agg(
        F.max("end").alias("length"), F.array_sort(F.collect_list(F.struct("start", "end", "pos", "word"))).alias("words")
    )


def overtalk(timed: DataFrame, seed: int = 0, max_overlap: float = 1.0) -> Split:
    """Pairs of files where the second starts before the first ends.

    Files fall into two halves by hash and meet by rank; the overlap is drawn by hash. The result is a plan:
    files, offset of the second, merged text in order of word starts, total length. Files of the larger half
    that find no partner are rejects.
    """
    # Names alone are numbered and paired; the words are joined to the pairs.
    names = timed.groupBy("audio_filepath").agg(F.max("end").alias("length"))
    halves = names.withColumn("_half", unit_hash(F.col("audio_filepath"), seed, "half") < 0.5)
    ordered = halves.withColumn("_order", hash_rank(F.col("audio_filepath"), seed, "order"))
    # Hashes are spread over 60 bits, so 2^20 ranges of 40 bits share the files evenly.
    ranked = dense_index(ordered, "_order", ["_half"], "_rank", row_bits=40, ties=["audio_filepath"])
    a = ranked.filter("_half").select("_rank", F.col("audio_filepath").alias("first_path"), F.col("length").alias("_la"))
    b = ranked.filter("NOT _half").select("_rank", F.col("audio_filepath").alias("second_path"), F.col("length").alias("_lb"))
    met = a.join(b, "_rank", "full")
    alone = met.filter("first_path IS NULL OR second_path IS NULL").select(
        F.coalesce("first_path", "second_path").alias("audio_filepath"), F.coalesce("_la", "_lb").alias("length"), F.lit("no_partner").alias("reason")
    )
    words_of = files_of_words(timed)
    met = met.filter("first_path IS NOT NULL AND second_path IS NOT NULL")
    met = met.join(words_of.select(F.col("audio_filepath").alias("first_path"), F.col("words").alias("_wa")), "first_path")
    met = met.join(words_of.select(F.col("audio_filepath").alias("second_path"), F.col("words").alias("_wb")), "second_path")
    overlap = unit_hash(F.col("first_path"), F.col("second_path"), seed) * F.least(F.lit(max_overlap), "_la", "_lb")
    met = met.withColumn("overlap", py_round(overlap, 3))
    offset = F.col("_la") - F.col("overlap")
    moved = F.transform(
        "_wb",
        lambda w: F.struct(
            (w["start"] + offset).alias("start"), (w["end"] + offset).alias("end"), w["pos"].alias("pos"), w["word"].alias("word")
        ),
    )
    merged = F.array_sort(F.concat("_wa", moved))
    pairs = met.select(
        "first_path",
        "second_path",
        "overlap",
        offset.alias("second_start"),
        F.greatest(F.col("_la"), offset + F.col("_lb")).alias("length"),
        F.array_join(F.transform(merged, lambda w: w["word"]), " ").alias("text"),
    )
    return Split(pairs, alone)


def insert_backchannels(
    timed: DataFrame, inserts: Sequence[tuple[str, float]], share: float = 1.0, seed: int = 0
) -> DataFrame:
    """Word rows with backchannel words placed in the middle of pauses long enough for them.

    ``inserts`` holds words and their lengths. A pause is the time to the next word, found by its number
    ``pos``, so even one endless file is shared among tasks.
    """
    spot = [F.col("audio_filepath"), F.col("pos")]
    choices = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(float(s)).alias("size")) for w, s in inserts])
    drawn = F.element_at(choices, (F.floor(unit_hash(*spot, seed, "word") * len(inserts)) + 1).cast("int"))
    following = timed.select("audio_filepath", (F.col("pos") - 1).alias("pos"), F.col("start").alias("_next"))
    paused = timed.join(following, ["audio_filepath", "pos"]).withColumn("_pick", drawn)
    pause = F.col("_next") - F.col("end")
    fits = (pause >= F.col("_pick.size")) & (unit_hash(*spot, seed, "gate") < share)
    begin = F.col("end") + (pause - F.col("_pick.size")) / 2
    added = paused.filter(fits).select(
        "audio_filepath",
        "pos",
        F.col("_pick.word").alias("word"),
        begin.alias("start"),
        (begin + F.col("_pick.size")).alias("end"),
        F.lit(True).alias("inserted"),
    )
    return timed.select("audio_filepath", "pos", "word", "start", "end", F.lit(False).alias("inserted")).unionByName(added)


def text_of_words(timed: DataFrame) -> DataFrame:
    """Transcript per file from its word rows, in order of time."""
    return files_of_words(timed).select("audio_filepath", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("text"))


def word_times(truth: DataFrame, timed: DataFrame, col: str = "text") -> DataFrame:
    """Times for ground-truth words from timed recogniser output.

    Words that align as equal or substituted take the times of their partner; deleted words have none.
    """
    files = files_of_words(timed)
    met = truth.select("audio_filepath", words(F.col(col)).alias("ref_words")).join(files, "audio_filepath", "left")
    times = F.array_sort(
        F.coalesce("words", F.array().cast("array<struct<start:double,end:double,pos:int,word:string>>"))
    )
    met = met.withColumn("words", times).withColumn("hyp_words", F.transform("words", lambda w: w["word"]))
    ops = spread(met).select("audio_filepath", "words", align_ops(F.col("ref_words"), F.col("hyp_words")).alias("ops"))

    def timed_word(o):
        slot = F.get(F.col("words"), o["hyp_pos"])
        return F.struct(o["ref_pos"].alias("pos"), o["ref"].alias("word"), o["op"].alias("op"), slot["start"].alias("start"), slot["end"].alias("end"))

    # Times are looked up before the moves become rows, so that no row carries the words of its file.
    spoken = F.filter("ops", lambda o: o["ref"].isNotNull())
    return ops.select("audio_filepath", F.transform(spoken, timed_word).alias("_timed")).select("audio_filepath", F.inline("_timed"))
