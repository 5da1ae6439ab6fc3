"""Training-data operators: shards, tokens, licenses, fingerprints, near copies, mixes, scores, archives.

Nothing outside this folder imports it.  ``queries`` holds the registered queries.
"""
