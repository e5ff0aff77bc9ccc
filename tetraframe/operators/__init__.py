"""Subpackage of tetraframe."""
