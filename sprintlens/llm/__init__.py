"""Operators of a training-data pipeline over documents, embeddings and conversations.

Nothing else in the package imports this one; `queries` registers one query per operator.
"""
