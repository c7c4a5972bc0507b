"""DataFrame operators. All are lazy except ``hierarchy`` (it checkpoints)."""
