"""Whole jobs put together from operators."""
