"""tidewatch: early-warning risk analytics as lazy Spark DataFrame operators.

Every public operator takes DataFrames (plus a frozen config) and returns a
DataFrame or a small driver-side scalar/dict; nothing row-level is collected.
"""

from tidewatch.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
__version__ = "0.1.0"
