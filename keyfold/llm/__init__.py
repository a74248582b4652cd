"""Operators of a training-data pipeline over a table of documents.

Every operator takes the names of its id and text columns and reads only those, so other
columns of the input, whatever their names, have no effect. Nothing else in the package
imports this folder.
"""
