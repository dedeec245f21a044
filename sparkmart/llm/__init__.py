"""Operators for preparing training text at scale.

Thirteen operators, one module each, and one module (``queries``) that registers a
query per operator. Nothing outside this folder imports it.
"""
