"""Ready-made plans: table chains, validation, repair, final tables, reports."""
