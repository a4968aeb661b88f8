"""Spark-native profiling, drift, recommendation-data and ranking operators.

Every public function takes and returns a lazy ``DataFrame``; nothing is
collected to the driver unless the docstring says so.
"""

from plumbline.session import build_session

__all__ = ["build_session"]
