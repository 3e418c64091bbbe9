"""Readers, sinks and test fixtures."""
