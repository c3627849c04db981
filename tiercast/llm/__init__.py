"""Operators for preparing language-model training data, independent of the rest of the package."""
