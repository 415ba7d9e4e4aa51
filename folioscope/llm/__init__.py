"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Every operator reads
only the columns it names, so extra columns of any name never clash, and it
returns the key column together with its own results.
"""
