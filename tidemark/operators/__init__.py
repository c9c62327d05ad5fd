"""Set-at-a-time operators over record, event, change and dead-letter tables."""
