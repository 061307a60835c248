"""Operators over DataFrames: change logs, corpus chunks, retrieval, guarded SQL, checks."""
