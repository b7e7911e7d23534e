"""plaudit: review analytics as Spark DataFrame operators.

Every public operator takes a DataFrame and returns a DataFrame; nothing is
collected to the driver. See README.md for the operator list.
"""

from plaudit.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
