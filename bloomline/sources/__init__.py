"""Landed files and pages in, tables out."""
