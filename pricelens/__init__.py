"""pricelens: catalogue comparison and price analysis on Spark DataFrames."""

from pricelens.session import build_session, materialise
from pricelens.settings import JoinKey, Settings, default_settings, load_settings

__all__ = ["JoinKey", "Settings", "build_session", "default_settings", "load_settings", "materialise"]
