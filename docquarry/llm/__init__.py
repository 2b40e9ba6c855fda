"""Training-data operators; nothing outside this package imports them.

``queries`` is the registry that ``__spark_entry__`` reads; importing one operator
does not import the others.
"""
