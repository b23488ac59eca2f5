"""Readers, writers and the adapter from plain tables to a graph."""
