"""The same transformations over streams of files."""
