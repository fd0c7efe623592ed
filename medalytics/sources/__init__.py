"""Landed pages, tables of the layers, raw schemas."""
