"""Training-data operators: ten corpus operators and their queries.

Nothing else in the library imports this subpackage.  Every operator takes
and returns DataFrames; :mod:`arrivals.llm.queries` has one registered query
per operator.
"""
