"""The whole job, and the query catalog over the test tables."""
