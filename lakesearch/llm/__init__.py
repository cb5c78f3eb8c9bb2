"""Operators for building training data, each by the method its module names."""
