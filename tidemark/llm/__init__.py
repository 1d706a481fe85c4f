"""Operators for language-model training data and their registered queries."""
