"""Registered queries over the driver tables and their independent SQL."""
