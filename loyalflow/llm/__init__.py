"""Operators for preparing training data; each module holds one operator and its registered query.

On a cluster whose executors don't have this package installed, call ``shared.ship(spark)`` once before an operator; the
registered queries do so themselves.
"""
