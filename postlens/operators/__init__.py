"""DataFrame-to-DataFrame operators: brands, places, lexicons, ledger, statistics."""
