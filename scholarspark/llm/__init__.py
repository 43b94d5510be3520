"""Operators for preparing training data: fingerprints, decontamination, toxicity, token counts,
sharding, language identification, near-duplicate joins, byte-level BPE, token files and
suffix-array deduplication. Nothing else in the package imports this subpackage.
"""
