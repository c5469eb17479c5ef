"""Reading text tables, stamping rows, writing artifacts, and fixture views."""
