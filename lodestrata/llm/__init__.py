"""Operators of a training-data pipeline on text and vectors. Nothing else in the package needs them."""
