"""Multi-job plans (the merge loop) and the registered queries with their SQL."""
