"""Operators for preparing large training corpora: deduplication, scoring, mixing, packing and output."""
