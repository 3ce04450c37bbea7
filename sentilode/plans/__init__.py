"""Whole jobs: training, validation and scoring plans put together from the operators."""
