"""Issue-tracker analytics as Spark DataFrames."""

from fieldtrail.config import Config
from fieldtrail.plans.model import Tracker

__all__ = ["Config", "Tracker"]
