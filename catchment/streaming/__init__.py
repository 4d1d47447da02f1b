"""Tables kept up to date by changed rows, in batches or from a stream of new files."""
