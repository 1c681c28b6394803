"""Registered queries, their SQL twins and the comparison between them."""
