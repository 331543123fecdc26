"""All checks, imported for their registration."""

from . import audio_checks, filter_checks, scoring_checks, set_checks, source_checks, text_checks  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
