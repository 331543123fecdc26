"""Training-set preparation: split, augment, measure, filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.augment import assign_noise, augment
from ..operators.filters import band_reason, blank_reason, first_reason, reason_if, split_by, Split
from ..operators.sampling import split_sets, with_variant


def prepare_training(
    clips: DataFrame, noise: DataFrame, key: str = "audio_filepath", seed: int = 0, max_s: float = 30.0, max_labels: int = 400
) -> Split:
    """``clips`` holds samples, sampling_rate, text and labels_length.

    Training clips also go in as an augmented copy. Lengths are measured after augmentation, so a copy never
    keeps the length of its original.
    """
    parted = split_sets(clips, key, seed=seed)
    noisy = assign_noise(parted.filter("split = 'train'"), noise, key, seed)
    copies = augment(noisy, key, seed=seed).select(*parted.columns)
    both = with_variant(parted, copies).withColumn("input_length", F.size("samples") / F.col("sampling_rate"))
    train, test = F.col("split") == "train", F.col("split") == "test"
    return split_by(
        both,
        first_reason(
            band_reason(F.col("input_length"), 0.0, max_s, inclusive=False, applies=train),
            F.when(train | test, reason_if(~(F.col("labels_length") < max_labels), "label_length")),
            blank_reason(F.col("text"), 2, ignore_blanks=False),
        ),
    )
