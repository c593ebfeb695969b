"""Operators for preparing training text, one module each, with their registered queries."""
