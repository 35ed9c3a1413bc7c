"""Operators of a training-data pipeline: scoring, deduplication, filtering, extraction, mixing.

Nothing else in the library imports this subpackage. ``catalog`` registers its queries."""
