"""Operators of a training-data pipeline: text, token, archive and vector work at corpus scale.

Nothing else in the library imports this subpackage.
"""
