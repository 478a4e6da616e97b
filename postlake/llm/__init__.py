"""Operators that prepare mailbox text for training. Nothing else in the library imports this."""
