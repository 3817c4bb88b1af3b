"""Readers of alignments, sequences, tables and configurations."""
