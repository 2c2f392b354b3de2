"""Operators for training data: tokens, near copies, archives, secrets, quality, licences, leaks.

Nothing outside this package imports it.
"""
