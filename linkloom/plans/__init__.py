"""Whole jobs composed from the operators: train, evaluate, search, gold."""
