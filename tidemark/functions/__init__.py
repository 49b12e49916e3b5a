"""Scalar column helpers."""

from tidemark.functions.scalars import (
    age_years,
    day_millis,
    day_text,
    event_time,
    first_non_null,
    is_blank,
    now_millis,
    second_millis,
    second_text,
)

__all__ = [
    "age_years",
    "day_millis",
    "day_text",
    "event_time",
    "first_non_null",
    "is_blank",
    "now_millis",
    "second_millis",
    "second_text",
]
