"""Imports every operator module, so that its queries are registered."""

from lexmill.llm import alignment, decontaminate, embeddings, langid, licenses, merkle, pieces, quality, sharding, simhash, tokenfiles, urlfilter, warc  # noqa: F401
from lexmill.llm.common import ORACLE, QUERIES  # noqa: F401
