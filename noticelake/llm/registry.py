"""All queries of this subpackage, with their SQL."""

from __future__ import annotations

from noticelake.llm import alignment, ann, bpe, conversations, exact_dedup, language, licenses, line_dedup, packing, pii, quality, secrets, simhash

MODULES = (exact_dedup, simhash, packing, bpe, quality, ann, secrets, pii, licenses, line_dedup, conversations, language, alignment)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracles() -> dict:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
