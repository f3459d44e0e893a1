"""Training-data operators: near-duplicate joins, sharding, classifiers,
vector search, packing, fingerprints, chat formatting, mixing and archives.

One module per operator; `queries.py` holds the thin registered queries.
Nothing outside this package imports it.
"""
