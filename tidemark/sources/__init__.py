"""Reading raw feeds and stored tables; writing results."""
