"""Stage runner: the operators put together with snapshots."""
