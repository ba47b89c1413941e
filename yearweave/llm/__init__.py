"""Training-data operators: tokenising, de-duplication, archiving, scoring, search and sharding.

Nothing else in the library imports this subpackage. ``registry`` lists its driver
queries; every operator module keeps a general DataFrame-in, DataFrame-out interface.
"""
