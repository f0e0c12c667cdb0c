"""Readers, declared schemas and sinks."""

from hourgrid.sources.schemas import SCHEMAS  # noqa: F401
from hourgrid.sources.readers import *  # noqa: F401,F403
from hourgrid.sources.sinks import *  # noqa: F401,F403
