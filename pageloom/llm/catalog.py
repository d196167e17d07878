"""Imports every operator, which registers its query."""

from pageloom.llm import (  # noqa: F401
    blocknames,
    classifier,
    html,
    mixing,
    packing,
    phrases,
    pii,
    quality_rules,
    simhash,
    suffixes,
    topk,
    warc,
    whitening,
)
