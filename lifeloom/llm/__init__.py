"""Operators for large-scale training-data preparation.

Nothing else in the library imports this folder.  ``queries.QUERIES`` and ``queries.ORACLES``
are its registered queries; ``__spark_entry__.py`` adds them when the folder is there.
"""
