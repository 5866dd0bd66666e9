"""Where transactions and their dimensions come from."""
