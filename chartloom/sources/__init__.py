"""Readers and writers for the tables the engine lands, stores and serves."""
