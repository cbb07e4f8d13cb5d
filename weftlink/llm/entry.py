"""Queries and SQL oracles of this subpackage."""

from weftlink.llm import chunks, fingerprint, hamming, langid, lmscore, mixing, packing, pii, simhash, suffixes

_PARTS = (chunks, fingerprint, hamming, langid, lmscore, mixing, packing, pii, simhash, suffixes)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
