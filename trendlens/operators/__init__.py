"""DataFrame operators.

- ``words``     tokens, stop-word removal, exact counts, keyword tracking
- ``sketch``    count-min sketch tables: build, estimate, merge, total, save/load, top-k
- ``bloom``     Bloom filter build and probe
- ``topk``      ordering, top-k, top-k string, approximate top-k
- ``store``     post parsing and the counted store of distinct texts
- ``search``    typed text queries over a Parquet search index
- ``entities``  entity extraction
- ``taps``      pass-through metrics
"""
