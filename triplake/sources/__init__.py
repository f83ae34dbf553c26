"""Readers: raw trip files, layer tables, file listings and test-data adapters."""
