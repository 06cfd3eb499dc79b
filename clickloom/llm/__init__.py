"""Operators of a training-data pipeline over ``documents``; nothing outside this subpackage imports it."""
