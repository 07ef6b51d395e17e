"""Uploads as a file stream."""
