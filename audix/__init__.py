"""Audience allocation on Spark.

Every operator takes and returns DataFrames and is written with the
DataFrame API only, so Catalyst plans it and the work runs on executors.
The user-facing runs are in :mod:`audix.plans.workflows`; the operators in
:mod:`audix.operators`.
"""

__version__ = "0.1.0"

__all__ = ["__version__"]
