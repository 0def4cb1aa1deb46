"""Each operator of the library on the test tables, and the same result in plain SQL."""
