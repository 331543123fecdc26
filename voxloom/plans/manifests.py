"""Manifest clean-up in one pass: band, marker, special characters, blank text, extension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import has_extension
from ..operators.filters import Split, band_reason, blank_reason, first_reason, inside_band, marker_reason, reason_if, special_reason, split_by


def manifest_reason(min_s: float = 1.0, max_s: float = 30.0) -> Column:
    """The first thing wrong with a manifest row, null for a good one."""
    text = F.col("text")
    return first_reason(
        band_reason(F.col("duration"), min_s, max_s),
        marker_reason(text),
        special_reason(text),
        blank_reason(text),
        reason_if(~has_extension(F.col("audio_filepath"), "wav"), "extension"),
    )


def clean_manifest(manifest: DataFrame, min_s: float = 1.0, max_s: float = 30.0) -> Split:
    """Rows fit for training, and the others with their reason."""
    return split_by(manifest, manifest_reason(min_s, max_s), inside_band(F.col("duration"), min_s, max_s))
