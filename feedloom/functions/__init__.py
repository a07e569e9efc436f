"""Column functions: text, dates, numbers, nested values, HTML, chunking."""
