"""Operators of a training-data pipeline over the tables documents, pages,
embeddings and labels. Nothing else in the package imports this folder."""
