"""Training-data operators: dedup, quality, sharding, URL rules, packing, token counts,
decontamination, personal data, repeated passages, similarity joins, search and whitening.

Nothing outside this sub-package imports it.  ``registry`` holds the registered queries.
"""
