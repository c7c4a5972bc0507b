"""Data readiness, de-identification and course analytics as Spark plans."""
