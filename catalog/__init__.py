"""The registered queries: their input from the test tables, and their SQL."""
