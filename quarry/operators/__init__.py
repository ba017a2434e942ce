"""Relational operators of the engine, each a composition of DataFrame operators."""
