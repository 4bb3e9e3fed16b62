"""Writers; all of them can be run again with the same result."""
