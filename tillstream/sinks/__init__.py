"""Where results go: keyed tables, JSON documents and keyed messages."""
