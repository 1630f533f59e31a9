"""Table sources and sinks."""

from cohortkit.sources.io import *  # noqa: F401,F403
