"""Scalar column functions (no UDFs)."""

from staylens.functions.scalar import *  # noqa: F401,F403
