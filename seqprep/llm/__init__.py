"""Training-data operators over document tables.

One module per operator; ``queries`` registers one query for each. Nothing
else in the library imports this package.
"""
