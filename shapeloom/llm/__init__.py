"""Operators that prepare text for training, their queries and their SQL.

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator over the shared tables; ``corpus_pipeline`` at the top of the
repository chains five of them.
"""
