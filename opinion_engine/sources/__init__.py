"""Readers and writers of the stage tables, CSV files and JSON documents."""
