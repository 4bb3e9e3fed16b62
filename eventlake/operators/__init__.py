"""Functions from DataFrame to DataFrame; none of them touches storage."""
