"""Column-expression builders (JVM-side, whole-stage-codegen friendly)."""

from cohortkit.functions.columns import *  # noqa: F401,F403
