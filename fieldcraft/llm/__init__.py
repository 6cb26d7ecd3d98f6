"""Training-data operators: each module is one operator over Spark tables.

Nothing outside this folder imports it.
"""
