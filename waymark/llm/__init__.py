"""Training-data operators: packing, near-dedup, language ID, BPE, filters, classifiers.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only when it can be imported.
"""
