"""Readers and writers for the flat files and tables the operators work on."""
