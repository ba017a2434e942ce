"""Training-data operators: ten Spark jobs over documents, pages and embeddings.

Nothing outside this folder imports it. Operators take a DataFrame plus column names, select the
columns they need first (so extra columns with any names cannot clash) and return a new DataFrame
with the columns listed in their docstring.
"""
