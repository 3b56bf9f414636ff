"""Expressions: text, cells, projection, planar and spherical geometry.

Longer formulas are Spark SQL text built from SQL arguments (usually column
names), for use with ``F.expr``.  The text is parsed in one call, which plans
much faster than the same formula put together from Column objects.
"""
