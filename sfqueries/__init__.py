"""The library's operators run over the driver's tables, each with equivalent DuckDB SQL."""

from . import aggregates, dims, facts, files, model, profiles, quality, reports, rows  # noqa: F401
from .base import REGISTRY

__all__ = ["REGISTRY"]
