"""Operators for training data: each module holds one, with its queries in :mod:`leafmill.llm.entries`."""
