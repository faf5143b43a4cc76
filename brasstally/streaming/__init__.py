"""Page-wise hooks on a stream of arriving rows."""
