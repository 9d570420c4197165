"""Writers: partitioned tables, snapshots, appends, upserts, loads into the warehouse copy."""
