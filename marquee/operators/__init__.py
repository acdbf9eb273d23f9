"""Frame-to-frame operators; column names are arguments."""
