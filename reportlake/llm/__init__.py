"""Training-data operators: ten corpus jobs and the pipeline built on them.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` holds the thin registered ones.
"""
