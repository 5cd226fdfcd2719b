"""Checks on the driver tables: raw feeds made from them, registered queries and their SQL."""
