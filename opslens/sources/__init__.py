"""Readers, writers, catalog discovery, stream envelopes and test-table fixtures."""
