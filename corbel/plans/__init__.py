"""The query catalogue: every operator on the test tables, with its SQL oracle."""
