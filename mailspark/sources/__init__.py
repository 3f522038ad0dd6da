"""Readers and writers: driver tables, mail folders, model tables, sinks."""
