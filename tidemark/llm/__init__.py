"""Operators for training data: each in a module of its own, with its query beside it."""
