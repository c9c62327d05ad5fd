"""Jobs: a store for logs and state, and the runs that fill it."""
