"""Catalogue localization analytics on PySpark."""
