"""Column functions: text, dates, prices, identifiers, places, arrays, JSON, HTML, URLs."""
