"""Readers, the lake's layout, manifests and writers."""
