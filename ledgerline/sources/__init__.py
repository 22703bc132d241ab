"""Readers, sinks, manifests and result records."""
