"""Operators for preparing training corpora (licence scans, packing, decontamination,
de-duplication, toxicity, sharding, quality, fingerprints, token counts).

Nothing outside this subpackage imports it.
"""
