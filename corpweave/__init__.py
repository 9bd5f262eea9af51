"""Corpweave: company records on Spark, from raw files to a searchable table."""

from corpweave.session import build_session
from corpweave.specs import SOURCES, SourceSpec, register, spec_for_path
from corpweave.operators import standardise as _standardise  # noqa: F401  registers the three sources

__all__ = ["SOURCES", "SourceSpec", "build_session", "register", "spec_for_path"]
