"""Every registered query; importing the package fills the registry."""

from adloom.suite import edges, encoding, reports, tables, vectors  # noqa: F401
from adloom.suite.common import ORACLES, QUERIES  # noqa: F401
