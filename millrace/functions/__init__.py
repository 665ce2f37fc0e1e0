"""Column functions: text, urls, dates, values and pieces of HTML."""
