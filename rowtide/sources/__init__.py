"""Feed readers: message queue, landed files, JSON rows."""
