"""Streaming forms of the ledger operators; each agrees with its batch form."""
