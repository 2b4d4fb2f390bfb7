"""Errors of pipelines."""


class DocloomError(Exception):
    """Any failure that the engine raises itself."""


class RuleError(DocloomError, ValueError):
    """A rule lacks an argument, or names an unknown column or operator."""


class ConfigError(DocloomError, ValueError):
    """A configuration that cannot be used."""


class SourceNotFound(DocloomError, FileNotFoundError):
    """No input matches."""


class SinkError(DocloomError, ValueError):
    """A table that cannot be written."""


class ModelCallError(DocloomError):
    """A refused, cut off or unusable answer of an external model."""
