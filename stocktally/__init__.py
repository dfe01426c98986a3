"""stocktally: retail and supply-chain analytics on PySpark DataFrames."""

from stocktally.config import DEFAULT, RetailConfig
from stocktally.session import build_session, tune

__all__ = ["DEFAULT", "RetailConfig", "build_session", "tune"]
