"""Spark-first record delivery: keying, routing, packing, shaping, outcomes and metrics as DataFrame functions."""
from sparkpack.config import PackConfig

__all__ = ["PackConfig"]
