"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from hourgrid.functions.scalar import *  # noqa: F401,F403
from hourgrid.functions.calendar import *  # noqa: F401,F403
