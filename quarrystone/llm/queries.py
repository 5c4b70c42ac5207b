"""All queries of this subpackage by name."""

from __future__ import annotations

from quarrystone.llm import bpe, chat, codes, decontamination, dedup, language, mixing, periodic, quality, scoring, secrets, topk, toxicity

_MODULES = (bpe, secrets, quality, chat, scoring, language, mixing, dedup, topk, toxicity, decontamination, periodic, codes)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
