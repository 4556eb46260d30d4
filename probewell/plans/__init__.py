"""Frames derived from the star-schema tables, and the registered queries over them."""
