"""Readers and writers: feeds, text blocks, JSON, XML and versioned state."""
