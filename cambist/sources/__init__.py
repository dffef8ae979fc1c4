"""Readers and writers: change streams, layer tables, rate documents, seeds."""
