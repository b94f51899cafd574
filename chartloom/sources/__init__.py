"""Readers and writers for staged documents, bundles and message rows."""
