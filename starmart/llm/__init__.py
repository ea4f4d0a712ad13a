"""Operators for preparing language-model training data, one module per operator.

Every operator takes DataFrames and returns a DataFrame. ``queries`` applies each of them to the
whole of its table; ``common`` has what several of them share.
"""
