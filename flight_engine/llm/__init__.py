"""Training-data operators over documents and web pages, and their queries."""
