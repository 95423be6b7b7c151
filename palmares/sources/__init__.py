"""Readers and writers: facts, correction sheets, code maps, published tables."""
