"""Column expressions: text escaping, codecs, strict JSON, snapshots, time."""
