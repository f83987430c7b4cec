"""Reading raw delimited lines and writing results."""
