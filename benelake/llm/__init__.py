"""Operators for building training corpora: dedup, packing, decontamination,
scoring, fingerprints, extraction and token files. Nothing else in the package
imports this one."""
