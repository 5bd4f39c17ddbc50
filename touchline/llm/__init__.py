"""Training-data operators: filters, de-duplication, tokenisation and packing.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and their SQL, ``/corpus_pipeline.py`` chains five of the operators.

    line_dedup.py    cross-site boilerplate lines (HyperLogLog site spread)
    pii.py           personal-data spans (patterns, checksums, context words)
    toxicity.py      boosted trees over dense features, isotonic calibration
    quality.py       tokeniser-fertility bands
    langid.py        cross-parsing entropy over suffix automata
    bpe.py           byte-level BPE through a serialised piece model
    embed_dedup.py   robust-pruned flat graph, range-expanding search
    url_filter.py    blocked Bloom filter and exact hash join
    packing.py       conflict-constrained best fit
    simhash.py       covering locality-sensitive hashing on 64-bit fingerprints
    components.py    connected components over a link table
    common.py        shared-folder tables, key filters, Arrow column helper
"""
