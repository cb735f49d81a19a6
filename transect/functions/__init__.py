"""Subpackage of transect."""
