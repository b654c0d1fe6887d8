"""textrail: Spark-native document retrieval and feedback analytics.

Every public operator is a pure function ``DataFrame -> DataFrame`` (or
``Column -> Column`` for scalar text rules).  Nothing here creates a
session, collects a table to the driver or runs per-row Python on the hot
path; the heavy lifting is left to Catalyst and whole-stage codegen.
"""

__version__ = "0.1.0"
