"""Operators of a training-data pipeline over documents, embeddings and labels.

Every operator reads only the columns it names, so further columns of its input,
whatever they are called, neither clash nor reach its result.
"""
