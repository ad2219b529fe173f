"""The daily feed as a file stream."""
