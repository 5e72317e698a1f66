"""Registers every query of the subpackage."""

from tallyport.llm import (  # noqa: F401 - importing registers the queries
    best_fit,
    burst_trie,
    decontamination,
    jaccard_join,
    language_id,
    mixing,
    pair_tiles,
    paragraph_dedup,
    repeats,
    sharding,
    token_files,
    topk_search,
    url_filter,
)
from tallyport.llm.registry import ORACLES, QUERIES  # noqa: F401
