"""Readers of delimited, block, annotation and sequence files."""
