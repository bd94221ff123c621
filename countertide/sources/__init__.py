"""Schemas, landed-file readers and writers, and the bindings to the test tables."""
