"""Training-data operators: one module per operator, registered as ``opN_<name>``.

Nothing else in the library imports this subpackage.
"""
