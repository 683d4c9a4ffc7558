"""turnout: club activity and attendance analytics as Spark DataFrame jobs."""

from .config import Config, LOCAL, WAREHOUSE  # noqa: F401

__version__ = "0.1.0"
