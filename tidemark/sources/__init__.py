"""Reading and writing the bronze, silver, gold and ledger tables."""
