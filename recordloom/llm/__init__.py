"""Training-data operators: one module for each, one common module, and the registry in ``registry.py``.

Nothing outside this subpackage imports it.
"""
