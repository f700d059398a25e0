"""Readers and writers for the text formats, and adapters from the test tables."""
