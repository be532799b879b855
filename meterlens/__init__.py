"""meterlens — readings analytics on Spark DataFrames.

A readings table is an entity (household), a time, a measured value (energy)
and an optional tariff.  Sources map any such table onto canonical columns;
operators are lazy ``DataFrame -> DataFrame`` functions built from native
Spark expressions; ``plans`` compose them into jobs; ``streaming`` ingests.
"""

from meterlens.schema import Roles, as_readings
from meterlens.session import build_session

__all__ = ["Roles", "as_readings", "build_session"]
__version__ = "0.1.0"
