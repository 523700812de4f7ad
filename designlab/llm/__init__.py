"""Training-data operators: URL filters, language id, toxicity, deduplication, BPE, packing.

Nothing outside this package imports it.
"""
