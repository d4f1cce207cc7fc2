"""Writers: appends, upsert logs and run ledgers."""
