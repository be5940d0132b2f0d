"""Operators for building text training data.

One module per operator (``simhash_lines``, ``divergence_rules``, ...); the
registered queries are in ``queries``.  Nothing outside this package imports it.
"""
