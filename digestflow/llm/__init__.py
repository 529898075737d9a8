"""Operators for training data built on the core; nothing outside this subpackage imports it."""
