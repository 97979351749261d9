"""Training-data operators on whole corpora. Nothing outside this folder imports it."""
