"""Writing tables: modes, raw appends, JSON runs, keyed upserts, versioned dimensions."""
