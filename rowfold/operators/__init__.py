"""DataFrame-to-DataFrame operators; all take column names and work on any table."""
