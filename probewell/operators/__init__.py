"""Operators over DataFrames, by topic: reads, pileup, score, coords, annotation, tracks, qc, chimera, duplex, matrix."""
