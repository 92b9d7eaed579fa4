"""All queries of this package; importing this module registers them."""

from __future__ import annotations

from . import alignment, ann, chat, extraction, langid, licenses, lines, merkle, minhash, mixing, packing, suffix, topk  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
