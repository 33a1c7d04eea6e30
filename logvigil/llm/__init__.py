"""Operators for building training corpora at scale; each module states its method and its edge cases."""
