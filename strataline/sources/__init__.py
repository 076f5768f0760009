"""Readers, writers, fingerprints and the versioned layer store."""
