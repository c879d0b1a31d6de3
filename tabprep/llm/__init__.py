"""Operators for preparing text and vectors for model training, one module per operator.

Nothing else in the library imports this package. Every operator is a function from DataFrame to DataFrame; output
columns replace input columns of the same name, all other columns are carried along.
"""
