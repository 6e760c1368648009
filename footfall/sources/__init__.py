"""Readers.  Schemas are declared; filters and column choices are pushed down."""
