"""Errors of the engine: one base, and a class for each phase that can refuse."""

from __future__ import annotations


class EngineError(Exception):
    """Base of all errors that the engine raises itself."""


class SchemaError(EngineError):
    """A schema text or spec that can't be used."""


class QueryError(EngineError):
    """Query text that doesn't parse."""


class AnalysisError(EngineError):
    """A query or target that doesn't fit the schema."""


class ConfigError(EngineError):
    """A job or system configuration that can't run."""


class JsonError(EngineError):
    """A JSON value whose root is neither an object nor an array."""
