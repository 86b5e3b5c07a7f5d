"""Table parity checks as Spark jobs: does a copy of a table still equal its source?"""

from evenkeel.errors import ConfigError, ParityFailure, SchemaDrift
from evenkeel.plans.compare import Comparison, compare, run_tables
from evenkeel.spec import TableSpec

__all__ = [
    "Comparison",
    "ConfigError",
    "ParityFailure",
    "SchemaDrift",
    "TableSpec",
    "compare",
    "run_tables",
]
