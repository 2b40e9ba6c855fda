"""Operators over the ledger, as DataFrame to DataFrame functions.

The ledger is never updated in place: truth is an append-only table of events,
and every statement that would change a row is a deterministic fold over it.
"""
