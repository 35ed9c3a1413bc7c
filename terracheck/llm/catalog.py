"""Import every module of this subpackage that registers queries."""

from __future__ import annotations

from terracheck.llm import bpe, decontam, filter_audit, html, jaccard, lattice, licenses, mixing, quality, secrets, simhash, suffixes, vector_codes  # noqa: F401
from terracheck.llm.registry import ORACLES, QUERIES  # noqa: F401
