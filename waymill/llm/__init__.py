"""Operators that prepare text corpora for training; nothing outside this subpackage imports it."""
