"""Training-data operators over document tables.

Each module holds one operator with a general interface (any id, text and
grouping column); ``queries`` derives the registered digests from them.
Nothing outside this package imports it.
"""
