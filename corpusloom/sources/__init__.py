"""Readers, ledgers and part stores."""
