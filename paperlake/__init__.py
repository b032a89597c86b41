"""Analytics over collections of paper records, as plain DataFrame functions."""
