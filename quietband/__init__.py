"""Spark-native analytics for longitudinal passive radio-survey telemetry."""

from quietband.config import SeriesConfig

__all__ = ["SeriesConfig"]
