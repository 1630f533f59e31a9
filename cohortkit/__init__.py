"""cohortkit: Spark-native tabular profiling, group-aware imputation, feature
building, cross-validated scoring, blending, threshold calibration and
evaluation for binary-outcome tables.

Every public operator is a plain ``DataFrame -> DataFrame`` function with
column names passed as parameters; nothing is collected to the driver except
small, size-bounded model state (a handful of scalars).
"""

__version__ = "0.1.0"
