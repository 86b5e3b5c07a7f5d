"""Typed failures, so that callers never have to parse a message."""


class ConfigError(ValueError):
    """A spec, name or request that cannot be run as written."""


class SchemaDrift(ValueError):
    """The two sides do not have the columns that the drift policy asks for."""

    def __init__(self, extra_in_source, extra_in_target):
        self.extra_in_source = sorted(extra_in_source)
        self.extra_in_target = sorted(extra_in_target)
        super().__init__(
            f"Schema mismatch: extra in target={self.extra_in_target}, "
            f"extra in source={self.extra_in_source}"
        )


class ParityFailure(RuntimeError):
    """At least one table of a finished run is in a failing status."""
