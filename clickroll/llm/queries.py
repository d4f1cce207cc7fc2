"""All queries of this subpackage: importing their modules registers them."""

from clickroll.llm import ann, chat, collocations, decontaminate, lines, pieces, pii, quality, repair, simhash, substrings, suffixes, token_files  # noqa: F401
from clickroll.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
