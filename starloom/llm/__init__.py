"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Every operator is a
function over DataFrames; the registered queries and their oracle SQL are
in ``entries``.
"""
