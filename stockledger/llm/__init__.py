"""Operators for training-data pipelines, one module per operator.

Nothing else in the package imports this subpackage. ``catalog`` names the
registered queries and their SQL; ``common`` holds what operators share.
"""
