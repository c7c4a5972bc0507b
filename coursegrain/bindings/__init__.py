"""The operators as named queries over the sample tables, each with its SQL."""

from . import cleaning, courses, frequencies, jobs, privacy, profiling, relations
from .registry import REGISTRY

__all__ = [
    "REGISTRY",
    "cleaning",
    "courses",
    "frequencies",
    "jobs",
    "privacy",
    "profiling",
    "relations",
]
