"""Operators for cleaning text corpora. Nothing else in the library imports this subpackage."""
