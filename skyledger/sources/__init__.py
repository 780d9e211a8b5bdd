"""Readers: every source as a DataFrame of text columns in file order (``_ord``)."""
