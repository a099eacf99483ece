"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``queries``
binds them to the registered ``opN_<name>`` keys. Nothing else in the library
imports this subpackage.
"""
