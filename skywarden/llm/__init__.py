"""Operators of a training-data pipeline over web documents.

Nothing outside this subpackage imports it.  Each module holds one
operator with a general interface; ``queries`` wraps them for the driver.
"""
