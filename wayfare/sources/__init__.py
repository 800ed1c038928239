"""Readers. Each returns a DataFrame; paths are URIs of any Hadoop file system."""
