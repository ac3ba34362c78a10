"""Operations of a training-data pipeline, one module per operator.

=============  =====================================================
``curves``     approximate nearest neighbours on shifted Hilbert curves
``language``   language identification by naive Bayes on hashed n-grams
``packing``    best-fit packing by length patterns (least squares)
``mixing``     mixing sources to target weights by subset sums
``chat``       chat formatting by schema fingerprints (built-in functions)
``licenses``   licence scans with a generalised suffix automaton
``tokens``     token counts with resynchronised overlapping chunks
``neardup``    near-duplicate groups from SetSketch registers
``topk``       exact top-k inner products with norm and residual bounds
``secrets``    secret scans by zstandard novelty
``pii``        personal data by weak supervision (built-in functions)
``negatives``  hard negatives from Hilbert-ordered blocks with zone maps
``merkle``     Merkle manifests by content-addressed descent
``queries``    the registered queries over the given tables
=============  =====================================================

Nothing else in the library imports this subpackage.
"""
