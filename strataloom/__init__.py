"""Data jobs for Spark: ingestion, modelling, quality, privacy and serving."""

from strataloom.session import build_session, configure, new_dir

__all__ = ["build_session", "configure", "new_dir"]
